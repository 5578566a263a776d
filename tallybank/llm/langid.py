"""Language identification: evidence of text, markup and address fused with smoothed priors of hosts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import ASCII_LOWER, lasting, map_texts
from tallybank.llm.urls import host_of

#: Byte trigrams are counted in 2 to this many buckets; this bounds the model for each language.
BUCKET_BITS = 14
#: Neighbouring trigrams share bytes, so a text counts for this share of its trigrams.
TEMPER = 1 / 3
#: Pages that the level above a host, domain or suffix is worth.
STRENGTH = 5.0
#: Added to counts of trigrams, and of declared languages.
SMOOTHING = 0.5
_SLICE = 1 << 16


def buckets(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a text, A-Z in lower case; a null or shorter text has none."""
    raw = np.frombuffer((text or "").encode().translate(ASCII_LOWER), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, dtype=np.int64)
    mixed = (raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def tongue(label: Column) -> Column:
    """The primary part of a language tag in lower case; null if it isn't two or three letters."""
    main = F.lower(F.regexp_extract(F.trim(label.cast("string")), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(main != "", main)


def trigram_counts(labelled: DataFrame, label_column: str = "lang", text_column: str = "text") -> DataFrame:
    """(lang, bucket, n) over all labelled texts. Tasks add up their texts first, so each sends one row at most for each
    language and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sums.setdefault(label, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
                held = buckets(text)
                if len(held) > 2000:
                    own += np.bincount(held, minlength=1 << BUCKET_BITS)
                else:
                    np.add.at(own, held, 1)
        for label, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), type=pa.string()), pa.array(at),
                                              pa.array(own[at])], names=["lang", "bucket", "n"])

    rows = labelled.select(tongue(labelled[label_column]).alias("l"), labelled[text_column].cast("string").alias("t"))
    sums = rows.where("l is not null").mapInArrow(run, "lang string, bucket long, n long")
    return sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def text_model(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log chances by bucket and language). What reaches the driver is bounded by buckets times languages."""
    rows = counts.collect()
    names = sorted({r["lang"] for r in rows})
    place = {n: i for i, n in enumerate(names)}
    sums = np.full((1 << BUCKET_BITS, len(names)), SMOOTHING)
    for r in rows:
        sums[r["bucket"], place[r["lang"]]] += r["n"]
    return names, np.log(sums / sums.sum(axis=0)).astype(np.float32)


def text_evidence(rows: DataFrame, keep: list[str], text_column: str, model: np.ndarray) -> DataFrame:
    """The columns `keep` with `evidence`: the tempered log likelihood of the text in each language."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def start():
        chances = sent.value

        def evidence(text: str | None) -> tuple:
            held, out = buckets(text), np.zeros(chances.shape[1])
            for at in range(0, len(held), _SLICE):
                out += chances[held[at:at + _SLICE]].sum(axis=0, dtype=np.float64)
            return ((out * TEMPER).tolist(),)
        return lambda texts: map(evidence, texts)

    made = T.StructType([T.StructField("evidence", T.ArrayType(T.DoubleType()))])
    return map_texts(rows, keep, text_column, made, start)


def page_rows(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
              html_column: str = "html") -> DataFrame:
    """Pages as (id, host, domain, suffix, declared, text). The domain is the last two parts of the host, the suffix the
    last one; declared is the lang of the html tag."""
    html = F.coalesce(pages[html_column].cast("string"), F.lit(""))
    host = host_of(pages[url_column])
    plain = F.regexp_replace(html, r"(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>", " ")
    declared = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([^"'\s>]+)""", 1)
    return pages.select(
        pages[id_column].alias("id"), host.alias("host"), F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0).alias("domain"),
        F.regexp_extract(host, r"[^.]*$", 0).alias("suffix"), tongue(declared).alias("declared"), plain.alias("text"))


def document_rows(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source",
                  text_column: str = "text") -> DataFrame:
    """Documents in the same form: the source takes the place of host and domain; nothing is declared."""
    source = F.coalesce(docs[source_column].cast("string"), F.lit(""))
    return docs.select(docs[id_column].alias("id"), source.alias("host"), source.alias("domain"), F.lit("").alias("suffix"),
                       F.lit(None).cast("string").alias("declared"), docs[text_column].cast("string").alias("text"))


def _counts_by(votes: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """One row for each key with the votes for each language as an array."""
    return votes.groupBy(*keys).agg(
        F.array(*[F.sum((F.col("vote") == i).cast("double")) for i in range(size)]).alias(name))


def _smoothed(counts: Column, above: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, above, lambda n, p: (n + STRENGTH * p) / (total + STRENGTH))


def fuse(judged: DataFrame, names: list[str]) -> DataFrame:
    """(id columns, text_lang, lang, confidence) from rows with evidence, host, domain, suffix and declared.

    Each row votes for the likeliest language of its text. The prior of a host is its votes, without the row's own,
    smoothed by those of its domain, these by the suffix, these by all rows. The chance of a declared language under
    each true one comes from the votes too. The posterior adds the three logarithms.
    """
    size = len(names)
    best = F.array_position(F.col("evidence"), F.array_max("evidence")).cast("int") - 1
    votes = lasting(judged.withColumn("vote", F.when(F.array_max("evidence") != 0.0, best).otherwise(F.lit(-1))))
    every = _counts_by(votes, [], size, "n").first()["n"] or [0.0] * size
    every = [n or 0.0 for n in every]
    base = F.array(*[F.lit((n + 1.0) / (sum(every) + size)) for n in every])
    by_host = _counts_by(votes, ["suffix", "domain", "host"], size, "h_n")
    by_domain = _counts_by(votes, ["suffix", "domain"], size, "d_n")
    by_suffix = _counts_by(votes, ["suffix"], size, "s_n").select("suffix", _smoothed(F.col("s_n"), base).alias("s_p"))
    priors = (by_host.join(by_domain, ["suffix", "domain"]).join(by_suffix, "suffix")
              .select(F.col("suffix").alias("p_suffix"), F.col("domain").alias("p_domain"), F.col("host").alias("p_host"),
                      "h_n", _smoothed(F.col("d_n"), F.col("s_p")).alias("d_p")))
    said = votes.where(F.col("declared").isin(names) & (F.col("vote") >= 0)).groupBy("vote", "declared").count().collect()
    table = np.full((size, size), SMOOTHING)                     # bounded by the square of the number of languages
    for r in said:
        table[names.index(r["declared"]), r["vote"]] += r["count"]
    table = np.log(table / table.sum(axis=0))
    declared = F.array(*[F.lit(0.0)] * size)
    for i, name in enumerate(names):
        declared = F.when(F.col("declared") == name, F.array(*[F.lit(float(x)) for x in table[i]])).otherwise(declared)
    own = F.transform(F.col("h_n"), lambda n, i: F.greatest(F.lit(0.0), n - (F.col("vote") == i).cast("double")))
    prior = F.transform(_smoothed(own, F.col("d_p")), lambda p: F.log(p))
    joined = votes.join(priors, (F.col("suffix") == F.col("p_suffix")) & (F.col("domain") == F.col("p_domain"))
                        & (F.col("host") == F.col("p_host")))
    fused = joined.withColumn("posterior", F.zip_with(
        F.zip_with(F.col("evidence"), declared, lambda a, b: a + b), prior, lambda a, b: a + b))
    top = F.array_max("posterior")
    named = F.array(*[F.lit(n) for n in names])
    return fused.select(
        *[c for c in judged.columns if c not in ("evidence", "host", "domain", "suffix")],
        F.when(F.col("vote") >= 0, F.get(named, F.col("vote"))).alias("text_lang"),
        F.get(named, F.array_position(F.col("posterior"), top).cast("int") - 1).alias("lang"),
        (1.0 / F.aggregate("posterior", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("confidence"))


def identify(rows: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """(all columns of `rows` but text, host, domain and suffix; text_lang, lang, confidence), one row for each row.

    `rows` has host, domain, suffix (not null), declared and text, as made by page_rows or document_rows. A null, empty or
    very short text has no text_lang; markup and the prior decide. Without any language in the model the results are
    null. Repeated rows and null ids come back as they are.
    """
    keep = [c for c in rows.columns if c != "text"]
    if not names:
        return rows.select(*[c for c in keep if c not in ("host", "domain", "suffix")],
                           *[F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")],
                           F.lit(None).cast("double").alias("confidence"))
    return fuse(text_evidence(rows, keep, "text", model), names)
