"""Document fingerprints by quartile bucket digests.

The byte triplets of a text, adjacent and with one byte left out, are hashed into 256
buckets and counted. Each bucket is written as the quartile its count lies in (two bits);
a code of the length and of the quartile ratios leads. Two digests differ by a score
bounded by ``FARTHEST``: circular length and ratio steps, and quartile steps per bucket
with opposite quartiles counting double. Likeness is 1 - difference / FARTHEST.

``fingerprint_pairs`` also digests an edited text of each document, whose last third of
code points is replaced by the start of the next document (descending id; after the last
the first). Documents are dealt by ranges of the id; only the first and last document of
a range, two per task, are matched up in a second step.

Defined cases: a null text is empty; documents of equal id stand in the order of their
texts' hashes; a null id comes last; a single document is its own next one; other columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python, stored

BUCKETS = 256
FARTHEST = 512  # difference from which two texts count as fully unlike
_RNG = np.random.Generator(np.random.PCG64(5))
_FIRST, _SECOND, _THIRD, _SKIPPED = (_RNG.permutation(256).astype(np.uint8) for _ in range(4))
_STEP = 1 << 20  # bytes counted at once
_HEX = "%02x%02x%s"


def _counts(data: np.ndarray) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(data) - 2, 0), _STEP):
        a = data[at : at + _STEP + 3]
        n = min(len(a) - 2, _STEP)
        one, two = _FIRST[a], _SECOND[a]
        total += np.bincount(one[:n] ^ two[1 : n + 1] ^ _THIRD[a[2 : n + 2]], minlength=BUCKETS)
        k = min(len(a) - 3, _STEP)
        if k > 0:
            total += np.bincount(one[:k] ^ two[1 : k + 1] ^ _SKIPPED[a[3 : k + 3]], minlength=BUCKETS)
    return total


def digest(text: str) -> str:
    """Hexadecimal digest: length code, ratio code, and 256 quartiles."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = _counts(data)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * i // 4 - 1]) for i in (1, 2, 3))
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    packed = (codes << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(255, round(np.log(len(data) + 1) / np.log(1.1)))
    ratios = (q1 * 100 // max(q3, 1) % 16) << 4 | (q2 * 100 // max(q3, 1) % 16)
    return _HEX % (length, ratios, packed.tobytes().hex())


_STEPS = np.array([[min(abs(i - j), 3) + 3 * (abs(i - j) == 3) for j in range(4)] for i in range(4)])
_PACKED = np.array(
    [[sum(int(_STEPS[a >> s & 3, b >> s & 3]) for s in (0, 2, 4, 6)) for b in range(256)] for a in range(256)],
    np.uint8,
)


def difference(one: str, two: str) -> int:
    """Bounded difference score of two digests; 0 for equal ones."""
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8) for x in (one, two))
    length = min(abs(int(a[0]) - int(b[0])), 12)
    ratios = 0
    for shift in (0, 4):
        gap = abs((int(a[1]) >> shift & 15) - (int(b[1]) >> shift & 15))
        ratios += min(gap, 16 - gap)
    return min(FARTHEST, 2 * length + ratios + int(_PACKED[a[2:], b[2:]].sum()))


def likeness(one: str, two: str) -> float:
    return 1.0 - difference(one, two) / FARTHEST


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_FIELDS = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]
_EDGE = [("range", pa.int32()), ("edge", pa.string()), ("text", pa.string())]
_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(doc_id, text: str, own: str, following: str, next_digest: str) -> tuple:
    changed = edited(text, following)
    other = digest(changed) if changed != text else own
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), sha, own, other, likeness(own, other), likeness(own, next_digest)


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _along_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each document with the one after it; hand out the ends of the range."""
    previous = None
    blank = (None,) * 5
    for batch in batches:
        out = []
        for number, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            own = digest(text)
            if previous is None:
                out.append((doc_id, len(text), *blank, number, "first", text))
            else:
                out.append((*_compared(*previous[1:], text, own), number, None, None))
            previous = (number, doc_id, text, own)
        yield _batch(out, _FIELDS + _EDGE)
    if previous is not None:
        number, doc_id, text, _ = previous
        yield _batch([(doc_id, len(text), *blank, number, "last", text)], _FIELDS + _EDGE)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        yield _batch([_compared(d, t, digest(t), n, digest(n)) for d, t, n in rows], _FIELDS)


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ready_python(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = dealt.select(F.spark_partition_id().alias("range"), "doc_id", "text")
    along = stored(
        numbered.mapInArrow(_along_range, f"{_COLUMNS}, range int, edge string, text string"), "fingerprints"
    )
    # Two rows per range that has rows: as many as there are tasks.
    first = along.filter("edge = 'first'").select("range", F.col("text").alias("head"))
    last = along.filter("edge = 'last'").select("range", "doc_id", "text")
    in_order = Window.orderBy("range")
    following = first.select(
        "range",
        F.coalesce(
            F.lead("head").over(in_order), F.first("head").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        ).alias("head"),
    )
    ends = last.join(following, "range").select("doc_id", "text", "head").mapInArrow(_ends, _COLUMNS)
    return along.filter("edge IS NULL").select(*[n for n, _ in _FIELDS]).unionByName(ends)
