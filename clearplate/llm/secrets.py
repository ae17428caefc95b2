"""Secrets in text, judged by who owns the copies.

Fixed patterns give the base spans; wider patterns give further candidates. Each candidate
is known by a hash of its value. Over the whole corpus the distinct repositories and owners
of a hash are counted: a value many of them hold is an example that was copied around, a
value of few is specific to its owner and looks live. Wider candidates become spans only if
they look live; base spans always stay.

Texts are scanned once. What is shuffled are hashes, cut to one row per hash, repository
and owner on each task first, so a value pasted into a third of all texts is a few rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.llm.base import filled, query, table
from clearplate.session import written

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN = 12

# The order in which kinds are listed; those after the third come from the method.
KINDS = ["assign", "access", "hex", "block", "login", "random"]
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s\\]*-----END [A-Z ]*PRIVATE KEY-----")
LOGIN = re.compile(r"://[^\s/:@]+:([^\s/:@]{6,})@")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}")
LEAST_BITS = 3.5
MAX_OWNERS = 2
MAX_REPOSITORIES = 3


def entropy(value: str) -> float:
    """Bits per character of a value."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """Candidates as (start, kind, end, value) in order; kinds below 3 are base spans."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    wide = []
    if "PRIVATE KEY" in text:
        wide += [(m.start(), 3, m.end(), m[0]) for m in BLOCK.finditer(text)]
    if "://" in text:
        wide += [(m.start(1), 4, m.end(1), m[1]) for m in LOGIN.finditer(text)]
    if any(c in text for c in "0123456789"):
        wide += [(m.start(), 5, m.end(), m[0]) for m in RANDOM.finditer(text) if entropy(m[0]) >= LEAST_BITS]
    # A wider candidate that overlaps a base span or an earlier one is left out.
    taken = sorted((s, e) for s, _, e, _ in found)
    at, reach = 0, 0
    for s, kind, e, value in sorted(wide):
        while at < len(taken) and taken[at][0] < e:
            if taken[at][1] > s:
                break
            at += 1
        if s >= reach and not (at < len(taken) and taken[at][0] < e and taken[at][1] > s):
            found.append((s, kind, e, value))
            reach = e
    return sorted(found)


def spans_text(found: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in found)


def candidates(docs: DataFrame, doc_id: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """One written row per document with its candidates; ``row`` numbers the rows."""
    schema = "doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<start:int,kind:int,end:int,hash:string>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, lists = ([], [], []), [], []
            for t in batch.column(3):
                found = scan(t.as_py())
                base = [f for f in found if f[1] < 3]
                for k in range(3):
                    counts[k].append(sum(f[1] == k for f in base))
                digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                lists.append([{"start": s, "kind": k, "end": e, "hash": hashlib.blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()} for s, k, e, v in found])
            columns = [*batch.columns[:3], *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(lists, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "found"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), filled(text).alias("text"))
    return written(slim.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "candidates")


def ownership(hashes: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``hash, n_owners, n_repositories, live`` over all rows ``hash, owner, repository``; null owners and repositories count as one each."""
    held = written(hashes.select("hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")).distinct(), "held")
    counts = held.groupBy("hash").agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("repository").alias("n_repositories"))
    return counts.withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories))


def find_secrets(docs: DataFrame, owner: Column, repository: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts, ``base_sha256``, ``spans``, ``n_live`` and ``n_shared``.

    ``spans`` lists base spans and the live-looking wider ones as ``kind:start:end`` in code
    points; ``n_live`` and ``n_shared`` count candidates of either verdict. Null and empty
    texts have none. Repeated rows return repeated rows; copies in one repository count
    once. Other columns of any name are ignored; an empty table gives no rows.
    """
    rows = candidates(docs, doc_id, text, owner, repository)
    each = rows.select("row", "owner", "repository", F.explode("found").alias("f")).select("row", "owner", "repository", "f.*")
    verdicts = written(ownership(each.select("hash", "owner", "repository")), "ownership")
    judged = each.join(verdicts, "hash")
    shown = F.when((F.col("kind") < 3) | F.col("live"), F.struct("start", "kind", "end"))
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(shown)).alias("shown"), F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_shared"))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_join(F.transform("shown", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    out = rows.drop("found").join(written(per_row, "judged"), "row", "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(spans, F.lit("")).alias("spans"), F.coalesce("n_live", none).alias("n_live"), F.coalesce("n_shared", none).alias("n_shared"))


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the owner; its texts of one language are a repository."""
    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
