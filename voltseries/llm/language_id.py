"""Language identification by Bayesian fusion of evidence.

For every language the log posterior adds up
- the text: a naive Bayes model of hashed byte trigrams, tempered so that a text counts
  for at most ``TEXT_TRIGRAMS`` independent trigrams;
- the declared markup language, which is right with probability ``DECLARED_TRUST``;
- the address suffix, if it belongs to one language, right with ``SUFFIX_TRUST``;
- the host: the share of the languages among its texts, smoothed towards its suffix's
  share, which is smoothed towards that of all texts. Counts are grouped aggregates over
  all rows.

Every language that at least ``MIN_DECLARED`` rows declare is modelled, however many there
are. The trigram models are fitted on at most about ``FIT_ROWS`` declared rows per language,
chosen by a hash of the id; everything else covers all rows. Models are held in groups of
``GROUP`` languages; a pass over the texts scores one group. The fusion looks at the
``CANDIDATES`` languages of each group that fit a text best, and at the declared one and
that of the suffix. A row that declares a rarer language, which has no model, is accepted as
declared where it would be rejected, unless it has no letters.

A row is accepted if its text has letters, its best language has a posterior of at least
``MIN_POSTERIOR``, and its trigrams are not mere noise to that language. A rejected
row keeps its best guess in ``language`` and names the reason; without letters it is "und".
Texts of fewer than ``NOISE_TRIGRAMS`` trigrams are not held against noise.

Defined cases: a null text is empty and rejected; a null declared language, host or suffix
is no evidence; repeated rows count and stay; rows that share an id, or have none, are
judged one by one; equal scores go to the first language by name; no rows give no rows; if
no language has a model, only rows with a declared one are accepted; a very long text is
scored whole, as one of its task's texts; other columns are ignored, and kept by
``accepted_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python, stored, unit_hash

FIT_ROWS = 2000
MIN_DECLARED = 20
GROUP = 64  # 34 MB of models
CANDIDATES = 16
BITS = 16
TEXT_TRIGRAMS = 200
DECLARED_TRUST = 0.9
SUFFIX_TRUST = 0.7
SMOOTHING = 10.0
MIN_POSTERIOR = 0.5
NOISE = -BITS * float(np.log(2))  # log-probability of a trigram by chance
NOISE_SHARE = 0.25  # of the way from noise to a language's own texts; below is noise
NOISE_TRIGRAMS = 100  # a shorter text is not held against noise
MAX_SMALL = 100_000  # rejected rows that may be broadcast (under 4 MB)
# Address suffixes that belong to one language.
SUFFIXES = {
    "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "cl": "es", "co": "es",
    "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt",
    "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "kr": "ko",
}

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
# Digits and punctuation say nothing of the language: all become a blank.
_LOWER[[c for c in range(128) if not chr(c).isalpha()]] = 32
_PIECE = 1 << 19


def _trigrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed trigrams of some texts, and where each of them starts and ends."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + _PIECE, "right")) - 1)
        low = _LOWER[raw[ends[i] : ends[j]]]
        code = (low[:-2] << 16 | low[1:-1] << 8 | low[2:]) if len(low) > 2 else low[:0]
        # Runs of blanks are left out; so are trigrams over the edge of a text.
        hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        blank = (low[:-2] == 32) & (low[1:-1] == 32) if len(low) > 2 else np.zeros(0, bool)
        hashed = np.where(blank, np.uint32(1 << BITS), hashed)
        starts = np.minimum(ends[i : j + 1] - ends[i], len(hashed))
        stops = np.maximum(starts[:-1], np.minimum(ends[i + 1 : j + 1] - ends[i] - 2, len(hashed)))
        yield hashed, np.stack([starts[:-1], stops], 1)
        i = j


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        names, row = batch.column(0).to_pylist(), 0
        for hashed, spans in _trigrams(batch.column(1)):
            for a, b in spans.tolist():
                into = counts.setdefault(names[row], np.zeros((1 << BITS) + 1, np.int64))
                if b > a:
                    into += np.bincount(hashed[a:b], minlength=len(into))
                row += 1
    for name, n in counts.items():
        at = np.flatnonzero(n[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at])], ["lang", "gram", "n"]
        )


def declared_languages(rows: DataFrame, least: int = MIN_DECLARED) -> dict[str, int]:
    """Rows per language, of the languages that enough rows declare."""
    declared = rows.filter("declared IS NOT NULL AND declared <> ''").groupBy("declared").count()
    return {r["declared"]: r["count"] for r in declared.filter(F.col("count") >= least).orderBy("declared").collect()}


def fit(rows: DataFrame, languages: dict[str, int], fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the trigrams, a row per language, and their mean over own texts.

    ``rows`` has id, text and declared; ``languages`` the number of rows that declare each.
    """
    names = list(languages)
    share = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, fit_rows / languages[n]))])
    some = rows.filter(unit_hash(F.col("id")) < share[F.col("declared")])
    found = some.select("declared", "text").mapInArrow(_counting, "lang string, gram long, n long")
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("lang")) - 1
    # At most 65,536 numbers per language.
    table = found.groupBy(number.alias("no"), "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(names), 1 << BITS))
    counts[table["no"].to_numpy(), table["gram"].to_numpy()] += table["n"].to_numpy()
    # What a language never wrote counts as noise, not as evidence against it: numbers,
    # keys and names are in texts of any language.
    smooth = counts + 0.1
    logs = np.maximum(np.log(smooth / smooth.sum(axis=1, keepdims=True)), NOISE)
    own = (counts * logs).sum(axis=1) / np.maximum(counts.sum(axis=1), 1)
    return np.hstack([logs, np.zeros((len(names), 1))]), own


def _kept(mean: np.ndarray, first: int, asked: list[np.ndarray]) -> np.ndarray:
    """Which languages of a group stay: the best of each row, and those that are asked for."""
    n = mean.shape[1]
    if n <= CANDIDATES:
        return np.ones(mean.shape, bool)
    kept = np.zeros(mean.shape, bool)
    best = np.argsort(-mean, axis=1, kind="stable")[:, :CANDIDATES]
    np.put_along_axis(kept, best, True, axis=1)
    for place in asked:
        mine = np.flatnonzero((place > first) & (place <= first + n))
        kept[mine, place[mine] - first - 1] = True
    return kept


def _scoring(model, first: int):
    """Adds the languages of one group, numbered from ``first``, to the candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = model.value
        for batch in batches:
            sums, sizes = [], []
            for hashed, spans in _trigrams(batch.column(batch.schema.get_field_index("text"))):
                edges = np.concatenate([[0], np.cumsum(hashed != 1 << BITS)])
                sizes.append(edges[spans[:, 1]] - edges[spans[:, 0]])
                upto = np.zeros(len(hashed) + 1)
                mine = np.empty((len(spans), len(logs)))
                for i, line in enumerate(logs):
                    np.cumsum(line[hashed], out=upto[1:])
                    mine[:, i] = upto[spans[:, 1]] - upto[spans[:, 0]]
                sums.append(mine)
            sums = np.concatenate(sums) if sums else np.zeros((0, len(logs)))
            sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            mean = sums / np.maximum(sizes, 1)[:, None]
            asked = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("said", "pointed")]
            kept = _kept(mean, first, asked)
            offsets = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32)
            new = {
                "n_grams": pa.array(sizes, pa.int64()),
                "langs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(kept)[1] + first, pa.int64())),
                "means": pa.ListArray.from_arrays(pa.array(offsets), pa.array(mean[kept])),
            }
            names = [n for n in batch.schema.names if n not in new]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in names], *new.values()], [*names, *new]
            )

    return run


_CARRIED = "id long, mark long, declared string, host string, suffix string, said long, pointed long"
_FOUND = "n_grams long, langs array<long>, means array<double>"


def _scored(rows: DataFrame, languages: dict[str, int], fit_rows: int) -> tuple[DataFrame, np.ndarray]:
    """Rows with n_grams and their candidates, an array of (lang, mean); and the own means."""
    names, owns = list(languages), []
    known = F.array(*[F.lit(n) for n in names])
    of_suffix = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    place = lambda c: F.coalesce(F.array_position(known, c), F.lit(0)).cast("long")
    current = rows.select(
        "id", "mark", "declared", "host", "suffix",
        place(F.col("declared")).alias("said"),
        place(F.try_element_at(of_suffix, F.coalesce("suffix", F.lit("")))).alias("pointed"),
        "text",
    )
    so_far = F.expr("cast(array() as array<struct<lang:bigint,mean:double>>)")
    current = current.withColumn("candidates", so_far)
    for first in range(0, len(names), GROUP):
        group = {n: languages[n] for n in names[first : first + GROUP]}
        logs, own = fit(rows, group, fit_rows)
        owns.append(own)
        model = rows.sparkSession.sparkContext.broadcast(logs)
        last = first + GROUP >= len(names)
        kept = f"{_CARRIED}, text string, candidates array<struct<lang:bigint,mean:double>>"
        added = current.mapInArrow(_scoring(model, first), f"{kept}, {_FOUND}")
        both = F.concat("candidates", F.arrays_zip(F.col("langs").alias("lang"), F.col("means").alias("mean")))
        added = added.withColumn("candidates", both).drop("langs", "means")
        current = stored(added.drop("text") if last else added, "language-scores")
        model.destroy()
        if not last:
            current = current.drop("n_grams")
    return current, np.concatenate(owns)


def _share(counts: Column, total: Column, lang: Column, prior: Column) -> Column:
    seen = F.coalesce(F.try_element_at(counts, lang), F.lit(0)).cast("double")
    return (seen + F.lit(SMOOTHING) * prior) / (F.coalesce(total, F.lit(0)) + F.lit(SMOOTHING))


def _tally(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key a map of the languages seen to their number, and the total."""
    entries = F.map_from_entries(F.collect_list(F.struct("best", "n")))
    by_key = rows.groupBy(*keys, "best").agg(F.sum("n").alias("n"))
    return by_key.groupBy(*keys).agg(entries.alias("c"), F.sum("n").alias("t"))


def identify(rows: DataFrame, fit_rows: int = FIT_ROWS, min_declared: int = MIN_DECLARED) -> DataFrame:
    """id, mark, declared, host, suffix, language, posterior, accepted, reason; a row per row.

    ``rows`` has id, text, declared, host, suffix and, if wanted, mark, which tells rows of
    one id apart.
    """
    ready_python(rows.sparkSession)
    if "mark" not in rows.columns:
        rows = rows.withColumn("mark", F.lit(0).cast("long"))
    # Blanks around a text let its first and last letters count.
    text = F.concat(F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" "))
    rows = rows.withColumn("text", text)
    languages = declared_languages(rows, min_declared)
    named = (F.col("declared") != "") & F.col("declared").isNotNull()
    if not languages:
        letters = F.regexp_like("text", F.lit(r"[A-Za-z\x{80}-\x{10FFFF}]"))
        kept = named & letters
        return rows.select(
            "id", "mark", "declared", "host", "suffix", F.when(kept, F.col("declared")).otherwise("und").alias("language"),
            F.when(kept, F.lit(DECLARED_TRUST)).otherwise(0.0).alias("posterior"),
            F.coalesce(kept, F.lit(False)).alias("accepted"),
            F.when(~letters, "no letters").when(~named, "no model").alias("reason"),
        )
    scored, own = _scored(rows, languages, fit_rows)
    names = list(languages)
    least = F.lit(NOISE + NOISE_SHARE * (own - NOISE))

    best = F.array_max(F.transform("candidates", lambda c: F.struct(c["mean"].alias("mean"), (-c["lang"]).alias("l"))))
    votes = (
        scored.filter("n_grams > 0")
        .groupBy("suffix", "host", (-best["l"]).alias("best"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    votes = stored(votes, "votes")
    hosts = _tally(votes, "suffix", "host").select(
        F.col("suffix").alias("_s"), F.col("host").alias("_h"), F.col("c").alias("of_host"), F.col("t").alias("host_total")
    )
    suffixes = _tally(votes, "suffix").select(
        F.col("suffix").alias("_x"), F.col("c").alias("of_suffix"), F.col("t").alias("suffix_total")
    )
    # One number per language.
    overall = np.ones(len(names))
    for r in votes.groupBy("best").agg(F.sum("n").alias("n")).collect():
        overall[r["best"]] += r["n"]
    everywhere = F.lit(overall / overall.sum())

    def evidence(place: Column, trust: float, lang: Column) -> Column:
        others = (1 - trust) / max(len(names) - 1, 1)
        value = F.when(place == lang + 1, F.lit(float(np.log(trust)))).otherwise(F.lit(float(np.log(max(others, 1e-6)))))
        return F.when(place == 0, F.lit(0.0)).otherwise(value)

    def fused_log(c: Column) -> Column:
        lang = c["lang"]
        of_suffix = _share(F.col("of_suffix"), F.col("suffix_total"), lang, F.get(everywhere, lang))
        prior = _share(F.col("of_host"), F.col("host_total"), lang, of_suffix)
        log = (
            F.log(prior)
            + F.least("n_grams", F.lit(TEXT_TRIGRAMS)) * c["mean"]
            + evidence(F.col("said"), DECLARED_TRUST, lang)
            + evidence(F.col("pointed"), SUFFIX_TRUST, lang)
        )
        return F.struct(log.alias("log"), (-lang).alias("l"), c["mean"].alias("mean"))

    joined = scored.join(
        hosts, F.col("suffix").eqNullSafe(F.col("_s")) & F.col("host").eqNullSafe(F.col("_h")), "left"
    ).join(suffixes, F.col("suffix").eqNullSafe(F.col("_x")), "left")
    fused = joined.withColumn("logged", F.transform("candidates", fused_log)).withColumn("top", F.array_max("logged"))
    total = F.aggregate("logged", F.lit(0.0), lambda s, x: s + F.exp(x["log"] - F.col("top.log")))
    foreign = (F.col("top.mean") < F.get(least, -F.col("top.l"))) & (F.col("n_grams") >= NOISE_TRIGRAMS)
    # Not one of the modelled languages, by its own word.
    odd = (F.col("posterior") < MIN_POSTERIOR) | foreign
    rare = named & (F.col("said") == 0) & odd & (F.col("n_grams") > 0)
    reason = (
        F.when(F.col("n_grams") == 0, "no letters")
        .when(rare, F.lit(None))
        .when(F.col("posterior") < MIN_POSTERIOR, "unsure")
        .when(foreign, "no known language")
    )
    language = F.when(F.col("n_grams") == 0, "und").when(rare, F.col("declared"))
    known = F.array(*[F.lit(n) for n in names])
    return (
        fused.withColumn("posterior", 1.0 / total)
        .withColumn("reason", reason)
        .select(
            "id", "mark", "declared", "host", "suffix",
            language.otherwise(F.get(known, -F.col("top.l"))).alias("language"),
            "posterior",
            F.col("reason").isNull().alias("accepted"),
            "reason",
        )
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents: ``lang`` is the declared language, ``source`` the host without a suffix."""
    kinds = {"text": "text", "declared": "lang", "host": "source"}
    return docs.select(
        F.col("doc_id").cast("long").alias("id"),
        *[F.col(c).cast("string").alias(n) for n, c in kinds.items()],
        F.lit(None).cast("string").alias("suffix"),
        _mark().alias("mark"),
    )


def _mark() -> Column:
    """Tells documents of one id apart: a hash of all that is judged."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("text", "lang", "source")])


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages: declared language of the markup, host and suffix of the address, visible text."""
    html, url = F.col("html").cast("string"), F.col("url").cast("string")
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    said = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").cast("long").alias("id"),
        bare.alias("text"),
        F.when(said != "", said).alias("declared"),
        F.when(host != "", host).alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)(?::\d+)?$", 1), F.lit("")).alias("suffix"),
        F.lit(0).cast("long").alias("mark"),
    )


def identify_documents(docs: DataFrame, fit_rows: int = FIT_ROWS, min_declared: int = MIN_DECLARED) -> DataFrame:
    found = identify(document_rows(docs), fit_rows, min_declared)
    return found.withColumnsRenamed({"id": "doc_id", "host": "source"}).drop("suffix", "mark")


def identify_pages(pages: DataFrame, fit_rows: int = FIT_ROWS, min_declared: int = MIN_DECLARED) -> DataFrame:
    return identify(page_rows(pages), fit_rows, min_declared).withColumnRenamed("id", "page_id").drop("mark")


def accepted_documents(docs: DataFrame, fit_rows: int = FIT_ROWS, min_declared: int = MIN_DECLARED) -> DataFrame:
    """The rows of ``docs`` without the rejected ones."""
    found = identify(document_rows(docs), fit_rows, min_declared)
    gone = stored(found.filter(~F.col("accepted")).select(F.col("id").alias("_id"), F.col("mark").alias("_gone")).distinct(), "rejected")
    # Few rejected rows are sent to the documents; many are met by a shuffle.
    gone = F.broadcast(gone) if gone.limit(MAX_SMALL + 1).count() <= MAX_SMALL else gone
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (_mark() == F.col("_gone"))
    return docs.join(gone, same, "left_anti").select(*docs.columns)
