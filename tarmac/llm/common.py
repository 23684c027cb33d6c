"""Helpers shared by the operators: safe columns, bounded samples, words, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import materialise, shared_folder

__all__ = ["components", "fold_of", "identified", "logistic", "materialise", "pieces", "shared_folder", "table", "utf8"]

#: Bytes of one piece of a text that a task turns into Python objects at a time.
PIECE = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(text: Column) -> Column:
    """The bytes of a text; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_did`` and ``_th``: the doc_id, null last, and a hash of the text. Rows alike in both are one text under one id."""
    return docs.withColumns({"_did": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), "_th": F.xxhash64(utf8(F.col("text")))})


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key's decimal text, modulo ``folds``; a null key is in no fold."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Cuts a text between words, so that long texts need bounded memory; a word of any length stays whole."""
    start, end = 0, len(text)
    while end - start > size:
        cut = min((k for k in (text.find(b" ", start + size), text.find(b"\n", start + size)) if k >= 0), default=end)
        yield text[start:cut]
        start = cut
    yield text[start:end]


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression by Newton steps. One class only: the bias alone answers."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if len(y) == 0:
        return w
    if y.min() == y.max():
        w[-1] = 4.0 if y[0] else -4.0
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph ``(u, v)``; the component is its smallest node.

    Alternates large-star and small-star until nothing changes, storing the edges in
    the shared folder after each round. A hub's edges are joined to the hub's
    minimum, a plain equality join that adaptive execution splits; no node's
    neighbours are ever gathered. Empty input gives an empty result; self-links only
    name a node.
    """
    first = stars = materialise(edges.where("u is not null and v is not null").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = stars.where("u <> v").unionByName(stars.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            joined.select("u", F.col("m").alias("v"))).distinct()
        kept = materialise(small)
        now = kept.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        stars, mark = kept, now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = first.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(stars.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "node", "left").select(
        "node", F.coalesce("m", "node").alias("component"))
