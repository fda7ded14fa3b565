"""Language identification with string kernels.

The kernel of two texts is a blended spectrum over presence: for every n from 1 to 4, the share of character n-grams
(hashed) that both hold, normalised by the numbers each holds, weighted and summed. Nystroem landmarks make it a
finite feature map, one-versus-rest kernel ridge regression is solved there, and since the kernel is a product of
presence rows with the landmarks', scoring a batch of texts is a few matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ready, text_of
from .tokens import text_slices

#: n-gram lengths with their weights, and hash slots for each length.
GRAMS, SLOTS = {1: 0.2, 2: 0.3, 3: 0.3, 4: 0.2}, 4096
#: Labelled texts to fit on, in all and of one language, and landmarks among them: the bound of what reaches the driver.
SAMPLE, LANDMARKS = 4000, 400
#: Weight of the penalty.
RIDGE = 1e-2
#: Score differences to probabilities.
SHARPNESS = 6.0


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """0/1 rows over len(GRAMS) * SLOTS hashed n-grams of the lower-cased texts, and the number of slots held for each n."""
    out = np.zeros((len(texts), len(GRAMS) * SLOTS), dtype=bool)
    lowered = [t.lower() for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    size = np.fromiter(map(len, lowered), dtype=np.int64, count=len(texts))
    row = np.repeat(np.arange(len(texts)), size)
    value = np.zeros(len(code), dtype=np.uint64)
    for k, n in enumerate(GRAMS):
        # value[i]: a polynomial of the n characters from i on
        value = value[: max(0, len(code) - n + 1)] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] + np.uint64(1)
        same = row[: len(value)] == row[n - 1 :]
        slot = ((value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(52)).astype(np.int64)
        out[row[: len(value)][same], k * SLOTS + slot[same]] = True
    held = out.reshape(len(texts), len(GRAMS), SLOTS).sum(axis=2)
    return out, held


def weighted(texts: list[str]) -> np.ndarray:
    """Presence rows scaled so that the kernel of two texts is the product of their rows."""
    rows, held = presence(texts)
    scale = np.sqrt(np.array(list(GRAMS.values())))[None, :] / np.sqrt(np.maximum(held, 1))
    return (rows.reshape(len(texts), len(GRAMS), SLOTS) * scale[:, :, None]).reshape(len(texts), -1).astype(np.float32)


@dataclass
class Model:
    """Languages and the weight of every slot for each; und where nothing was learned."""

    languages: list[str]
    weights: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        scores = weighted(texts) @ self.weights
        p = np.exp(SHARPNESS * (scores - scores.max(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        heard = [any(map(str.isalpha, t)) for t in texts]  # Unicode category L
        return [self.languages[b] if h else "und" for b, h in zip(best, heard, strict=True)], [float(p[i, b]) if heard[i] else 0.0 for i, b in enumerate(best)]


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """One-versus-rest kernel ridge regression on Nystroem features; texts and languages are the bounded sample."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((len(GRAMS) * SLOTS, 0), dtype=np.float32))
    own = np.array(languages)
    chosen = np.concatenate([np.flatnonzero(own == n)[: max(1, landmarks // len(names))] for n in names])
    z = np.concatenate([weighted([texts[k] for k in chosen[i : i + 100]]) for i in range(0, len(chosen), 100)])
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # K_zz to the power -1/2, on its range
    phi = np.concatenate([(weighted(texts[i : i + 100]) @ z.T).astype(np.float64) for i in range(0, len(texts), 100)]) @ root
    y = np.where(own[:, None] == np.array(names)[None, :], 1.0, -1.0)
    share = 1.0 / np.array([(own == n).sum() for n in own])[:, None]  # every language weighs the same
    a = np.linalg.solve(phi.T @ (phi * share) + ridge / len(names) * np.eye(phi.shape[1]), phi.T @ (y * share))
    return Model(names, (z.T.astype(np.float64) @ (root @ a)).astype(np.float32))


def labelled_sample(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> tuple[list[str], list[str]]:
    """Texts and languages of at most `sample` labelled rows, as many of each language as there are, up to an equal share.

    Rows are drawn by a hash of their id (then of their text), so the sample doesn't depend on how they are dealt.
    Candidates are thinned by that hash before they are put in order, by a rate that follows the counts. Every language
    is learned; more languages than sample are an error.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_of(text_col).alias("_text"), F.col(f"`{label_col}`").cast("string").alias("_lang")).filter("_lang is not null and trim(_text) <> ''")
    counts = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).limit(sample + 1).collect()}
    if not counts:
        return [], []
    if len(counts) > sample:
        raise ValueError(f"more than {sample} languages; the sample has to grow with them")
    each = sample // len(counts)
    draw = F.pmod(F.xxhash64("_id", F.substring("_text", 1, 200)), F.lit(1 << 30))
    rate = F.coalesce(*[F.when(F.col("_lang") == n, F.lit(min(1.0, 2.0 * each / c + 50 / c))) for n, c in counts.items()], F.lit(0.0))
    thin = rows.withColumn("_d", draw).filter(F.col("_d") < rate * float(1 << 30))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_d", "_id", "_text"))  # over the thinned rows, some 2 * each a language
    taken = sorted((r["_lang"], r["_i"], r["_text"]) for r in thin.withColumn("_i", place).filter(F.col("_i") <= each).select("_lang", "_i", "_text").collect())
    return [t for _, _, t in taken], [n for n, _, _ in taken]


def train(docs: DataFrame, **params) -> Model:
    texts, languages = labelled_sample(docs, **params)
    return fit(texts, languages)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows of docs as a struct `row` (without the text), with `lang_pred` and `score` (0 to 1).

    und with score 0 for null texts and texts without a letter. The whole text counts. Repeated rows are judged alike.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # (4 * 4096) floats a language: its size doesn't depend on the data

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text", 1 << 20):
            langs, scores = [], []
            texts = batch.column("_text").to_pylist()
            for i in range(0, len(texts), 250):
                got = shared.value.predict(texts[i : i + 250])
                langs += got[0]
                scores += got[1]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    keep = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(keep.alias("row"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(judge, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = train(docs.filter(~out))
    found = identify(docs.select("doc_id", "text"), model).select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
