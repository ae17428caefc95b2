"""All queries of the pipeline operators."""

from clearplate.llm import exact_dedup, langid, language_model, main_text, merkle, mixing, pieces, quality_model, quality_rules, secrets, simhash, token_alignment, word_bpe  # noqa: F401
from clearplate.llm.base import ORACLES, QUERIES  # noqa: F401
