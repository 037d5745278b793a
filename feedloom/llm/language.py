"""Language identification as a mixture: which languages a text is made of, and in which proportions.

The model has, for each language, how likely every hashed trigram of bytes is. Trigrams are counted over all training
documents. A document's log-likelihood under a mixture of languages is concave in the proportions: expectation-
maximisation finds the best ones. Its languages are chosen one after the other: the one under which the text alone is
most likely, then always the one with the steepest rise, as long as the likelihood rises by more than its penalty,
which grows with the logarithm of the text's length as in the Bayesian information criterion.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing can be learned;
a null lang or a null id is not learned from; a null id is not held out; equal proportions go to the language that comes
first; repeated rows are learned from and predicted each for itself; other columns are not looked at.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT = 4, 2
BUCKET_BITS = 16
SMOOTHING = 0.5
#: Steps of expectation-maximisation, and what a language more costs in halves of the logarithm of the trigrams.
STEPS, PENALTY = 25, 6.0
CHUNK_BYTES = 1 << 20
UNKNOWN = "und"
#: Lower-case letters stay, other ASCII is a gap between words, bytes of other characters stay.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LATIN = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_LATIN.search(text) is not None or any(map(str.isalpha, text)))


def buckets(text: str) -> np.ndarray:
    """Hashed trigrams around every letter."""
    b = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8).astype(np.uint32)
    codes = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[b[1:-1] != 32]
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task's trigrams by language, summed before anything is shuffled."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            if text:
                mine = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                found = buckets(text)
                if len(found) > 1 << BUCKET_BITS:
                    mine += np.bincount(found, minlength=1 << BUCKET_BITS)
                else:
                    np.add.at(mine, found, 1)
    for lang, mine in counts.items():
        at = np.flatnonzero(mine)
        yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": mine[at]})


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the likelihood of each bucket in each. The size depends on languages, not on rows."""
    training = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = training.select("lang", "text").mapInPandas(_counted, "lang string, bucket int, n bigint")
    totals = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(totals["lang"].unique())
    table = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    table[totals["bucket"].to_numpy(int), totals["lang"].map(place).to_numpy(int)] += totals["n"].to_numpy(float)
    return languages, (table / table.sum(axis=0)).astype(np.float32)


def _expectation_maximisation(p: np.ndarray, c: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray):
    """p: likelihood of each trigram in each chosen language; c: its count; doc: whose it is. Proportions, likelihood."""
    share = np.full((len(start), p.shape[1]), 1 / p.shape[1])
    for _ in range(STEPS):
        parts = p * share[doc]
        parts *= (c / parts.sum(axis=1))[:, None]
        share = np.add.reduceat(parts, start, axis=0) / n[:, None]
    mixed = (p * share[doc]).sum(axis=1)
    return share, np.add.reduceat(c * np.log(mixed), start), mixed


def mixtures(texts: list[str], table: np.ndarray) -> list[tuple[list[int], np.ndarray]]:
    """Languages (by number) and proportions of each text; every text has a letter."""
    found = [buckets(t) for t in texts]
    key = np.concatenate([f.astype(np.int64) | i << BUCKET_BITS for i, f in enumerate(found)])
    key, c = np.unique(key, return_counts=True)
    doc, gram, c = key >> BUCKET_BITS, key & ((1 << BUCKET_BITS) - 1), c.astype(np.float64)
    start = np.searchsorted(doc, np.arange(len(texts)))
    n = np.add.reduceat(c, start)
    p = table[gram].astype(np.float64)
    alone = np.add.reduceat(c[:, None] * np.log(p), start, axis=0)
    chosen = alone.argmax(axis=1)[:, None]
    best = alone.max(axis=1)
    share, mixed = np.ones((len(texts), 1)), np.take_along_axis(p, chosen[doc], axis=1)[:, 0]
    result = [([int(k[0])], s) for k, s in zip(chosen, share, strict=True)]
    live = np.arange(len(texts))  # texts to which a language may still be added
    while chosen.shape[1] < p.shape[1]:
        slope = np.add.reduceat(p * (c / mixed)[:, None], start, axis=0) - n[:, None]
        np.put_along_axis(slope, chosen, -np.inf, axis=1)
        rises = slope.max(axis=1) > 0  # else no proportion of any other language helps
        live, chosen, best, n, rows = live[rises], chosen[rises], best[rises], n[rises], rises[doc]
        if not len(live):
            break
        chosen = np.hstack([chosen, slope[rises].argmax(axis=1)[:, None]])
        p, c, doc = p[rows], c[rows], np.cumsum(rises)[doc[rows]] - 1
        start = np.searchsorted(doc, np.arange(len(live)))
        share, likely, mixed = _expectation_maximisation(np.take_along_axis(p, chosen[doc], axis=1), c, doc, start, n)
        better = likely - best > PENALTY / 2 * np.log(n)
        for i in np.flatnonzero(better):
            result[live[i]] = (chosen[i].tolist(), share[i])
        rows = better[doc]
        live, chosen, best, n = live[better], chosen[better], likely[better], n[better]
        if not len(live):
            break
        p, c, mixed, doc = p[rows], c[rows], mixed[rows], np.cumsum(better)[doc[rows]] - 1
        start = np.searchsorted(doc, np.arange(len(live)))
    return result


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (its proportion), mixture (language to proportion)."""
    languages, table = learn(docs)
    model = docs.sparkSession.sparkContext.broadcast((languages, table))

    @F.pandas_udf("lang_pred string, score double, mixture map<string,double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, likely = model.value
        rows: list = [(UNKNOWN, 0.0, {})] * len(texts)
        waiting: list[int] = []

        def flush() -> None:
            found = mixtures([texts.iloc[i] for i in waiting], likely)
            for i, (chosen, share) in zip(waiting, found, strict=True):
                first = min(range(len(chosen)), key=lambda j: (-share[j], chosen[j]))
                shares = {names[k]: float(min(1.0, s)) for k, s in zip(chosen, share, strict=True)}
                rows[i] = (names[chosen[first]], float(min(1.0, share[first])), shares)
            waiting.clear()

        size = 0
        for i, text in enumerate(texts):
            if names and has_letter(text):
                waiting.append(i)
                size += len(text)
            if waiting and size >= CHUNK_BYTES:
                flush()
                size = 0
        if waiting:
            flush()
        return pd.DataFrame(rows, columns=["lang_pred", "score", "mixture"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.mixture")
