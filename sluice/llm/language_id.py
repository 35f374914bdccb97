"""Language ID by interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

A text is a bag of words (runs of letters, lower-cased); a model predicts each letter of a word, and its end, from the
``ORDER - 1`` characters before it inside the word.  The language with the least cross-entropy per character is chosen.

*Learning.*  From labelled rows whose ``crc32(doc_id)`` modulo 3 isn't 1.  At most about ``SAMPLE_DOCS`` whole documents per
language are read (chosen by a hash of doc_id; the bound on the sample, and with it on the model).  Counts of top-order
grams are combined in Spark; lower orders use continuation counts, as Kneser-Ney asks.  One gram table per order is
kept: sorted 64-bit hashes with, per language, the interpolated probability of the gram and its back-off weight as a
context.

*Calibration.*  A fifth of the sample isn't counted but scored.  It gives each language's usual cross-entropy and its
spread per character, hence the limit beyond which a text is rejected (``REJECT_Z`` deviations plus ``REJECT_MARGIN``
nats), and the temperature of the score.

Scoring reads every document in full; a word that occurs often in a block of texts is scored once.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; a null doc_id isn't held out
and not learned from; without any labelled row all are ``und``; repeated rows are each reported; ties go to the first
language in code point order; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

ORDER, SAMPLE_DOCS, REJECT_Z, REJECT_MARGIN, SEED = 4, 2000, 6.0, 1.0, 77
TOKEN = C.byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LETTERS = re.compile(r"[^\W\d_]+")
BLOCK = 2 * C.CHUNK


@dataclass
class Model:
    langs: list[str]
    hashes: list[np.ndarray]  # per order, sorted
    prob: list[np.ndarray]  # (grams, langs); 0 where a language has not seen the gram
    backoff: list[np.ndarray]  # (grams, langs); 1 where it is no context
    unseen: np.ndarray  # per language: probability of a character never seen
    usual: np.ndarray | None = None  # mean cross-entropy
    spread: np.ndarray | None = None  # deviation of one character
    heat: float = 1.0


def _gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of grams given as code point columns, first character first."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = C.mix(h * np.uint64(C.BASES[0]) + c.astype(np.uint64))
    return h


def _hash_strings(grams: list[str]) -> np.ndarray:
    size = len(grams[0])
    cp = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, size)
    return _gram_hash([cp[:, i] for i in range(size)])


def kneser_ney(counts: dict[str, dict[str, int]], order: int = ORDER) -> Model:
    """Model from top-order gram counts per language; a gram's last character is the predicted one."""
    langs = sorted(counts)
    prob: list[dict[str, list[float]]] = [defaultdict(lambda: [0.0] * len(langs)) for _ in range(order)]
    back: list[dict[str, list[float]]] = [defaultdict(lambda: [1.0] * len(langs)) for _ in range(order)]
    unseen = np.ones(len(langs))
    for li, lang in enumerate(langs):
        levels = [Counter(counts[lang])]
        for _ in range(order - 1):  # continuation counts: kinds of longer grams that end in this one
            levels.insert(0, Counter(g[1:] for g in levels[0]))
        lower: dict[str, float] = {}
        for n, level in enumerate(levels, 1):
            ones, twos = sum(c == 1 for c in level.values()), sum(c == 2 for c in level.values())
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            total, kinds = Counter(), Counter()
            for g, c in level.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            here = {}
            if n == 1:
                unseen[li] = d * kinds[""] / total[""] / (kinds[""] + 1)
            for g, c in level.items():
                share = d * kinds[g[:-1]] / total[g[:-1]]
                here[g] = (c - d) / total[g[:-1]] + (share * lower[g[1:]] if n > 1 else unseen[li])
                prob[n - 1][g][li] = here[g]
            if n > 1:
                for h in kinds:
                    back[n - 2][h][li] = d * kinds[h] / total[h]
            lower = here
    hashes, probs, backs = [], [], []
    for n in range(order):
        grams = sorted(set(prob[n]) | set(back[n]))
        keys = _hash_strings(grams) if grams else np.zeros(0, np.uint64)
        at = np.argsort(keys)
        hashes.append(keys[at])
        probs.append(np.array([prob[n][g] for g in grams]).reshape(-1, len(langs))[at])
        backs.append(np.array([back[n][g] for g in grams]).reshape(-1, len(langs))[at])
    return Model(langs, hashes, probs, backs, unseen)


def _padded(tokens: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all letter runs, each with ``order - 1`` blanks before and one after; predicted places; their token."""
    cp = np.frombuffer(("\n".join(tokens) + "\n").lower().encode("utf-32-le"), np.uint32)
    kinds, which = np.unique(cp, return_inverse=True)
    letter = np.array([chr(k).isalpha() for k in kinds.tolist()])[which]
    token = np.cumsum(cp == 10) - (cp == 10)
    at = np.flatnonzero(letter)
    if not len(at):
        return np.zeros(0, np.uint32), at, at
    new = np.concatenate(([True], np.diff(at) > 1))
    run = np.cumsum(new) - 1
    place = np.arange(len(at)) + run * order + order - 1  # each run adds order - 1 blanks and an end
    out = np.full(int(place[-1]) + 2, 32, np.uint32)
    out[place] = cp[at]
    last = place[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    predicted = np.concatenate([place, last + 1])
    owner = np.concatenate([token[at], token[at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]]])
    return out, predicted, owner


def token_scores(model: Model, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: negative log-probability and its square sum per language, and predicted characters."""
    n_lang, order = len(model.langs), len(model.hashes)
    total, squares, size = np.zeros((len(tokens), n_lang)), np.zeros((len(tokens), n_lang)), np.zeros(len(tokens))
    for a in range(0, len(tokens), 20_000):
        part = tokens[a : a + 20_000]
        text, at, owner = _padded(part, order)
        if not len(at):
            continue
        p = np.broadcast_to(model.unseen, (len(at), n_lang))
        weight = np.ones((len(at), n_lang))
        for n in range(1, order + 1):
            if n > 1:  # the context of this order is the (n - 1)-gram before
                key = _gram_hash([text[at - k] for k in range(n - 1, 0, -1)])
                table = model.hashes[n - 2]
                i = np.minimum(np.searchsorted(table, key), len(table) - 1)
                weight = np.where((table[i] == key)[:, None], model.backoff[n - 2][i], 1.0)
            key = _gram_hash([text[at - k] for k in range(n - 1, -1, -1)])
            table = model.hashes[n - 1]
            i = np.minimum(np.searchsorted(table, key), len(table) - 1)
            seen = np.where((table[i] == key)[:, None], model.prob[n - 1][i], 0.0)
            p = np.where(seen > 0, seen, p * weight)
        cost = -np.log(p)
        size[a : a + len(part)] = np.bincount(owner, minlength=len(part))
        for j in range(n_lang):
            total[a : a + len(part), j] = np.bincount(owner, cost[:, j], len(part))
            squares[a : a + len(part), j] = np.bincount(owner, cost[:, j] ** 2, len(part))
    return total, squares, size


def text_scores(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same per text; words are scored once."""
    starts, ends, words = C.word_spans(data, bounds, TOKEN)
    rows, n_lang = len(bounds) - 1, len(model.langs)
    if not len(starts):
        return np.zeros((rows, n_lang)), np.zeros((rows, n_lang)), np.zeros(rows)
    _, first, which = np.unique(C.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    raw = data.tobytes()
    tokens = [raw[s:e].decode() for s, e in zip(starts[first].tolist(), ends[first].tolist())]
    total, squares, size = token_scores(model, tokens)
    row = np.repeat(np.arange(rows), np.diff(words))
    add = lambda x: np.bincount(row, x[which], rows)
    each = lambda m: np.stack([add(m[:, j]) for j in range(n_lang)], axis=1)
    return each(total), each(squares), add(size)


# -- learning ----------------------------------------------------------------------
def _gram_counts(order: int):
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                grams = counts[lang]
                for word, c in Counter(LETTERS.findall(text.lower())).items():
                    w = " " * (order - 1) + word + " "
                    for i in range(len(word) + 1):
                        grams[w[i : i + order]] += c
        rows = [(k, g, c) for k, grams in counts.items() for g, c in grams.items()]
        for a in range(0, len(rows), 100_000):
            yield C.batch(schema, *[list(x) for x in zip(*rows[a : a + 100_000])])

    return run


def learn(documents: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A calibrated model, or None without labelled text.  ``documents``: doc_id, text, lang of the rows to learn from."""
    rows = documents.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    counts = {r.lang: r.c for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()}  # one row per language
    if not counts:
        return None
    rate = F.create_map(*[F.lit(x) for lang, c in counts.items() for x in (lang, min(1.0, sample_docs / c))])
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000))
    sample = C.cut(rows.filter(draw < 1_000_000 * F.element_at(rate, F.col("lang"))).select(
        "lang", "text", (F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(5)) == 0).alias("aside")), "lang-sample")
    grams = sample.filter("NOT aside").drop("aside").mapInArrow(_gram_counts(order), "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    by_lang: dict[str, dict[str, int]] = defaultdict(dict)
    for r in grams.collect():  # bounded by the sample
        by_lang[r.lang][r.gram] = r.c
    if not by_lang:
        return None
    model = kneser_ney(by_lang, order)
    return calibrate(model, sample)


def calibrate(model: Model, sample: DataFrame) -> Model:
    shared = sample.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    n = len(model.langs)
    schema = pa.schema([("lang", pa.string()), ("n", pa.float64()), ("cost", pa.list_(pa.float64())), ("square", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            for i, j in C.row_chunks(bounds, BLOCK):
                total, squares, size = text_scores(shared.value, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                yield C.batch(schema, b.column("lang").slice(i, j - i), size, list(total), list(squares))

    scored = sample.filter("aside").drop("aside").mapInArrow(run, "lang string, n double, cost array<double>, square array<double>")
    got = [r for r in scored.collect() if r.n > 0]  # a fifth of the bounded sample, a few numbers each
    usual, spread = np.full(n, 2.5), np.full(n, 2.0)
    for j, lang in enumerate(model.langs):
        own = [r for r in got if r.lang == lang]
        chars = sum(r.n for r in own)
        if chars:
            usual[j] = sum(r.cost[j] for r in own) / chars
            spread[j] = max(0.1, sum(r.square[j] for r in own) / chars - usual[j] ** 2) ** 0.5
    model.usual, model.spread = usual, spread
    model.heat = min((0.003, 0.01, 0.03, 0.1, 0.3, 1.0), key=lambda t: _log_loss(model, got, t))
    return model


def _log_loss(model: Model, rows: list, heat: float) -> float:
    loss = 0.0
    for r in rows:
        if r.lang in model.langs:
            cost = np.array(r.cost)
            z = -(cost - cost.min()) * heat
            loss -= z[model.langs.index(r.lang)] - np.log(np.exp(z).sum())
    return loss


def decide(model: Model, total: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language number, score, cross-entropy and rejection of texts with ``size`` characters (0: all rejected)."""
    n = np.maximum(size, 1)
    best = np.argmin(total, axis=1)
    least = total[np.arange(len(n)), best]
    score = 1.0 / np.exp(-(total - least[:, None]) * model.heat).sum(axis=1)
    entropy = least / n
    limit = model.usual[best] + REJECT_MARGIN + REJECT_Z * model.spread[best] / np.sqrt(n)
    return best, np.where(size > 0, score, 0.0), np.where(size > 0, entropy, 0.0), (size == 0) | (entropy > limit)


PREDICTION = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


def predict(documents: DataFrame, model: Model | None, keep_rows: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` per document (and all input columns as the struct ``row``)."""
    rows = documents.select(F.struct("*").alias("row")) if keep_rows else documents.select(F.struct("doc_id", "text").alias("row"))
    out = T.StructType(T.StructType.fromDDL(PREDICTION).fields + rows.schema.fields * keep_rows)
    names = out.fieldNames()
    if model is None:
        return rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0.0).alias("cross_entropy"), F.lit(True).alias("rejected"), "row").select(*names)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = np.array(shared.value.langs, object)
        for b in batches:
            row = b.column("row")
            ids = row.field("doc_id").cast(pa.int64())
            data, bounds, _ = C.text_bytes(row.field("text"))
            for i, j in C.row_chunks(bounds, BLOCK):
                total, _, size = text_scores(shared.value, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                best, score, entropy, no = decide(shared.value, total, size)
                got = C.batch(schema, ids.slice(i, j - i), np.where(size > 0, langs[best], "und").tolist(), score, entropy, no)
                if keep_rows:
                    got = pa.RecordBatch.from_arrays([*got.columns, row.slice(i, j - i)], names=names)
                yield got

    return rows.mapInArrow(run, out)


def remainder(modulus: int = 3):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", "lang")
    model = learn(docs.filter(remainder() != 1))
    return predict(docs, model).withColumn("held_out", F.coalesce(remainder() == 1, F.lit(False)))
