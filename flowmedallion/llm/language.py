"""Language identification as a mixture: each document's language shares by expectation-maximisation.

Words (runs of letters, lower-cased) are the items of the mixture.  A word's likelihood in a
language is the product of its letter trigrams' smoothed frequencies there, word edges
included; trigrams are hashed into a table of fixed size, so the model's size is bounded by
languages x BUCKETS.  A document's shares start at the languages' frequencies and are raised
by EM under a small Dirichlet prior.  Its language set grows one language at a time, in the
order of the shares, while the likelihood gains more than the penalty of ln(words) / 2 (the
Bayesian information criterion); the shares of the chosen set are estimated anew.

``lang_pred`` is the language with the largest share in the set (the first in order of name
among equals), ``score`` its share when all languages take part, near 1 / languages for a word
or two of unclear origin.  Texts that are null or hold no letter are ``und`` with score 0; so
is every text where no labelled document taught a language.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmedallion.llm.batches import append_columns, numbered, place, restored, slices, small_batches, utf8

FIT_DOCS = 3_000
"""About so many labelled documents of each language are learned from: a hashed share of them."""
BUCKETS = 1 << 16
MOST_LANGUAGES = 500
ROUNDS = 12
PRIOR = 0.5
SMOOTH = 0.5
WORDS_KEPT = 200_000
"""Words whose likelihoods a task remembers before it starts anew."""
BLOCK_WORDS = 1 << 15
"""Documents are estimated together until they have so many words."""
UNKNOWN = "und"

runs = re.compile(r"[^\W\d_]+").findall


def letters(data: bytes) -> list[str]:
    """The words of a text, lower-cased; none if it holds no letter."""
    text = data.decode(errors="replace")
    return runs(text.lower()) if any(map(str.isalpha, text)) else []


def grams(word: str) -> list[int]:
    """Buckets of a word's trigrams, edges marked by spaces."""
    data = f" {word} "
    return [zlib.crc32(data[i : i + 3].encode()) % BUCKETS for i in range(len(data) - 2)]


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    start: np.ndarray
    """The languages' shares among the labelled documents."""
    logs: np.ndarray
    """BUCKETS x languages: log frequencies of trigrams."""


def held_out(doc_id: str = "doc_id") -> Column:
    """Ids that never teach: crc32 of the id as text leaves 2 when divided by 4 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn_languages(docs: DataFrame, text: str = "text", lang: str = "lang", fit_docs: int = FIT_DOCS) -> Languages:
    """Learn trigram frequencies from labelled documents; about ``fit_docs`` of each language are read."""
    labelled = docs.filter(f"{lang} is not null and {text} is not null").select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    found = labelled.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if not found:
        return Languages((), np.empty(0), np.empty((BUCKETS, 0)))
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"at most {MOST_LANGUAGES} languages can be learned")
    names = [r["lang"] for r in found]
    total = sum(r["count"] for r in found)
    place = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, fit_docs / r["count"]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.filter(draw < share[F.col("lang")]).select(place[F.col("lang")].alias("place"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(names), BUCKETS), dtype=np.int64)
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in slices(batch, "text"):
                for i, data in zip(piece.column("place").to_pylist(), utf8(piece.column("text")), strict=True):
                    for word in letters(data):
                        own = kept.get(word)
                        if own is None:
                            own = kept[word] = np.array(grams(word))
                        np.add.at(table[i], own, 1)
                    if len(kept) > WORDS_KEPT:
                        kept.clear()
        i, bucket = np.nonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(table[i, bucket])],
            names=["place", "bucket", "n"],
        )

    rows = (
        small_batches(chosen).mapInArrow(count, "place int, bucket int, n long").groupBy("place", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros((BUCKETS, len(names)))
    counts[rows["bucket"].to_numpy(), rows["place"].to_numpy()] = rows["n"].to_numpy()
    logs = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * BUCKETS))
    return Languages(tuple(names), np.array([r["count"] / total for r in found]), logs)


class Words(dict):
    """Word -> row of a growing table of likelihoods, scaled to 1 in the word's best language."""

    def __init__(self, logs: np.ndarray) -> None:
        super().__init__()
        self.logs = logs
        self.rows = np.empty((1 << 12, logs.shape[1]))

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        log = self.logs[grams(word)].sum(axis=0)
        self.rows[at] = np.exp(log - log.max())
        self[word] = at
        return at


def mix(likely: np.ndarray, sizes: np.ndarray, allowed: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares (languages x documents) and log likelihoods by EM over words.

    ``likely`` is languages x words, document after document; ``sizes`` (all above 0) are the
    documents' numbers of words.
    """
    first = np.cumsum(sizes) - sizes
    shares = allowed * start[:, None]
    shares /= shares.sum(axis=0)
    prior = PRIOR * allowed
    for _ in range(ROUNDS):
        joint = likely * np.repeat(shares, sizes, axis=1)
        joint /= joint.sum(axis=0) + 1e-300
        shares = np.add.reduceat(joint, first, axis=1) + prior
        shares /= shares.sum(axis=0)
    log = np.log((likely * np.repeat(shares, sizes, axis=1)).sum(axis=0) + 1e-300)
    return shares, np.add.reduceat(log, first)


def choose(likely: np.ndarray, sizes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the chosen language sets (0 outside), and shares over all languages; languages x documents."""
    n, docs = len(start), len(sizes)
    full, log_full = mix(likely, sizes, np.ones((n, docs)), start)
    rank = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0)
    penalty = np.log(sizes) / 2
    best = (rank < 1).astype(float)
    first = np.cumsum(sizes) - sizes
    worth = np.add.reduceat(np.log((likely * np.repeat(best, sizes, axis=1)).sum(axis=0) + 1e-300), first)
    going = np.arange(docs)
    for size in range(2, n + 1):
        # no set can be likelier than about all languages together, so who could not win then is done
        going = going[log_full[going] + 1.0 - (size - 1) * penalty[going] > worth[going]]
        if not len(going):
            break
        mine = np.repeat(np.isin(np.arange(docs), going), sizes)
        shares, log = mix(likely[:, mine], sizes[going], (rank[:, going] < size).astype(float), start)
        gain = log - (size - 1) * penalty[going]
        better = gain > worth[going]
        going = going[better]
        best[:, going], worth[going] = shares[:, better], gain[better]
    return best, full


def with_languages(df: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``langs`` (the chosen set: name -> share); columns called so are replaced."""
    names, start, logs = model.names, model.start, model.logs
    shared = df.sparkSession.sparkContext.broadcast(logs)  # languages x BUCKETS numbers at most

    def make() -> Callable:
        kept = Words(shared.value)

        def work(texts: list[bytes | None]) -> list[pa.Array]:
            pred, score, sets = [], [], []
            at: list[int] = []
            sizes: list[int] = []

            def settle() -> None:
                words = np.array(sizes, dtype=np.int64)
                some = words > 0
                if some.any():
                    likely = np.ascontiguousarray(kept.rows[np.array(at, dtype=np.int64)].T)
                    best, full = choose(likely, words[some], start)
                    top = best.argmax(axis=0)
                place = np.cumsum(some) - 1
                for i, own in zip(place.tolist(), some.tolist(), strict=True):
                    pred.append(names[top[i]] if own else UNKNOWN)
                    score.append(float(full[top[i], i]) if own else 0.0)
                    sets.append([(names[j], float(best[j, i])) for j in np.nonzero(best[:, i])[0]] if own else [])
                at.clear()
                sizes.clear()

            for data in texts:
                words = letters(data) if data and names else ()
                at.extend(map(kept.__getitem__, words))
                sizes.append(len(words))
                if len(at) >= BLOCK_WORDS:
                    settle()
            settle()
            if len(kept) > WORDS_KEPT:
                kept.clear()
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))]

        return work

    return append_columns(df, text, "lang_pred string, score double, langs map<string,double>", make)


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", least: float = 0.4) -> DataFrame:
    """The documents in which one language holds at least the share ``least`` of the text's language set, with the
    columns they had; the number of learned languages has no part in that, as it has in ``score``.

    Learns from the labelled documents of the same frame whose id is not held out; without any,
    nothing is judged and every document stays.
    """
    model = learn_languages(docs.filter(~held_out(doc_id) & F.col(doc_id).isNotNull()), text, lang)
    if not model.names:
        return docs
    judged = with_languages(numbered(docs), model, place(docs, text))
    return restored(judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("langs")[F.col("lang_pred")] >= least)), docs)
