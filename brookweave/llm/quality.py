"""Per-document text statistics, and the texts that are no natural prose.

A text is cut into *units*: lines, with hard-wrapped lines joined again. Every unit gets a vector of statistics
(:mod:`brookweave.llm.units`). A Gaussian mixture with full covariances is fitted by expectation-maximization on the
standardised vectors of all units of all documents; each component gets a class (prose, list, table, junk) from
inspected examples; a document's classes are the shares of its visible characters by the class of the component that
answers for the unit. Nothing but the mixture decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookweave.llm.examples import EXAMPLES
from brookweave.llm.units import FEATURES, common_hashes, unit_statistics
from brookweave.session import persist_table, spread

CLASSES = ("prose", "list", "table", "junk")
#: Units scored at once.
ROWS = 8192
#: Statistics on whose grid units are counted for the fit, with the edges: at most 186,624 cells, each with its exact
#: first and second moments of all statistics.
GRID = {
    "log_words": (1.2, 2.0, 2.8), "common_share": (0.05, 0.15, 0.3), "symbol_share": (0.03, 0.15), "digit_share": (0.05, 0.3),
    "cells": (0.1, 0.5), "marker": (0.5,), "ends_sentence": (0.5,), "repetition": (0.4,), "word_length": (3.0, 6.0),
    "vowel_share": (0.2, 0.5), "strange_share": (0.05,), "log_block_lines": (0.9, 1.7),
}


def grid_cells(stats: np.ndarray) -> np.ndarray:
    """Mixed-radix number of the grid cell of every row of statistics."""
    code = np.zeros(len(stats), dtype=np.int64)
    for name, edges in GRID.items():
        code = code * (len(edges) + 1) + np.searchsorted(edges, stats[:, FEATURES.index(name)], side="right")
    return code


class Mixture:
    """Gaussian mixture over standardised statistics with a class per component."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray):
        self.centre, self.scale = centre, scale
        self.weights, self.means = weights, means
        self.classes: np.ndarray = np.zeros(len(weights), dtype=int)
        self.set_covariances(covariances)

    def set_covariances(self, covariances: np.ndarray) -> None:
        """Takes weights and means as they are. All log densities are one product: of the second powers, the statistics and 1
        with a table of one column per component."""
        d = self.means.shape[1]
        i, j = np.triu_indices(d)
        precision = np.linalg.inv(covariances)
        precision = (precision + precision.transpose(0, 2, 1)) / 2
        self.log_dets = -0.5 * np.linalg.slogdet(covariances)[1]
        straight = np.einsum("kij,kj->ki", precision, self.means)
        constant = np.log(self.weights + 1e-300) + self.log_dets - 0.5 * (straight * self.means).sum(1)
        self.table = np.concatenate((-precision[:, i, j] * np.where(i == j, 0.5, 1.0), straight, constant[:, None]), axis=1).T
        self.diagonals = -0.5 * np.diagonal(precision, axis1=1, axis2=2).T

    @staticmethod
    def powers(z: np.ndarray) -> np.ndarray:
        i, j = np.triu_indices(z.shape[1])
        return np.concatenate((z[:, i] * z[:, j], z, np.ones((len(z), 1))), axis=1)

    def log_densities(self, z: np.ndarray, scatter: np.ndarray | None = None, powers: np.ndarray | None = None) -> np.ndarray:
        """Weighted log density of every component; with the ``scatter`` (variances) of cells, its mean over the cell."""
        log = (self.powers(z) if powers is None else powers) @ self.table
        return log if scatter is None else log + scatter @ self.diagonals

    def responsibilities(self, z: np.ndarray, scatter: np.ndarray | None = None) -> np.ndarray:
        log = self.log_densities(z, scatter)
        log -= log.max(1, keepdims=True)
        p = np.exp(log)
        return p / p.sum(1, keepdims=True)

    def class_shares(self, stats: np.ndarray) -> np.ndarray:
        """Probability of every class for every row of statistics."""
        named = np.eye(len(CLASSES))[self.classes]
        parts = [stats[at : at + ROWS] for at in range(0, len(stats), ROWS)]
        return np.concatenate([self.responsibilities((x - self.centre) / self.scale) @ named for x in parts] or [np.zeros((0, len(CLASSES)))])


def fit_mixture(
    counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, components: int = 48, rounds: int = 40, floor: float = 0.05, restarts: int = 3, splits: int = 3
) -> Mixture:
    """Expectation-maximization over grid cells (``counts`` units with the statistics' ``sums`` and sums of ``squares``).

    A cell answers as a whole, with the scatter inside it, so means and variances are those of the units. Of several
    starts the likeliest end counts; a start draws cells by squared distance from those drawn before (fixed seeds, cells
    in a fixed order). After it has settled, ``splits`` times the sixth of the components that are widest along an axis
    are cut in two there and all are fitted again: a rare kind of text does not stay hidden in a wide component."""
    total = counts.sum()
    centre = sums.sum(0) / total
    scale = np.sqrt(np.maximum(squares.sum(0) / total - centre**2, 0)) + 1e-3
    means = sums / counts[:, None]
    z = (means - centre) / scale
    scatter = np.maximum(squares / counts[:, None] - means**2, 0) / scale**2
    ends = []
    for seed in range(restarts):
        weights, centres, covariances = _start(counts, z, components, seed)
        for stage in range(splits + 1):
            if stage:
                weights, centres, covariances = _split(weights, centres, covariances, max(1, components // 6))
            score, weights, centres, covariances = _maximize(counts, z, scatter, weights, centres, covariances, rounds, floor)
        ends.append((score, weights, centres, covariances))
    _, weights, centres, covariances = max(ends, key=lambda e: e[0])
    return Mixture(centre, scale, weights, centres, covariances)


def _start(counts: np.ndarray, z: np.ndarray, components: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    picked = [int(counts.argmax())]
    far = ((z - z[picked[0]]) ** 2).sum(1)
    while len(picked) < min(components, len(z)) and far.sum() > 0:
        p = far * np.sqrt(counts)
        picked.append(int(rng.choice(len(z), p=p / p.sum())))
        far = np.minimum(far, ((z - z[picked[-1]]) ** 2).sum(1))
    k, d = len(picked), z.shape[1]
    return np.full(k, 1.0 / k), z[picked].copy(), np.repeat(0.5 * np.eye(d)[None], k, 0)


def _split(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``n`` widest components in two, one to either side along their longest axis."""
    values, axes = np.linalg.eigh(covariances)
    widest = np.argsort(-values[:, -1], kind="stable")[:n]
    step = axes[widest, :, -1] * np.sqrt(values[widest, -1:])
    kept = covariances.copy()
    kept[widest] -= 0.75 * step[:, :, None] * step[:, None, :]
    means = means.copy()
    means[widest] -= step
    weights = weights.copy()
    weights[widest] /= 2
    return np.concatenate((weights, weights[widest])), np.concatenate((means, means[widest] + 2 * step)), np.concatenate((kept, kept[widest]))


def _maximize(
    counts: np.ndarray, z: np.ndarray, scatter: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray, rounds: int, floor: float
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    total, (k, d) = counts.sum(), means.shape
    model = Mixture(np.zeros(d), np.ones(d), weights, means, covariances)
    prior = max(2.0, total / 20_000)  # pseudo units per component, so that none shrinks to a point
    powers = Mixture.powers(z)
    i, j = np.triu_indices(d)
    score = last = -np.inf
    for _ in range(rounds):
        log = model.log_densities(z, scatter, powers)
        top = log.max(1, keepdims=True)
        p = np.exp(log - top)
        score = float((counts * (top[:, 0] + np.log(p.sum(1)))).sum() / total)
        if abs(score - last) < 1e-3:
            break
        last = score
        r = p / p.sum(1, keepdims=True) * counts[:, None]
        moments = r.T @ powers
        mass = moments[:, -1] + 1e-9
        model.weights, model.means = mass / mass.sum(), moments[:, -1 - d : -1] / mass[:, None]
        square = np.empty((k, d, d))
        square[:, i, j] = square[:, j, i] = moments[:, : len(i)]
        square -= mass[:, None, None] * model.means[:, :, None] * model.means[:, None, :]
        square[:, range(d), range(d)] += r.T @ scatter
        covariances = (square + prior * 0.2 * np.eye(d)) / (mass + prior)[:, None, None] + floor * np.eye(d)
        model.set_covariances(covariances)
    return score, model.weights, model.means, covariances


def name_components(model: Mixture, stats: np.ndarray, labels: np.ndarray) -> None:
    """Give every component the class of the inspected examples that it answers for. An example counts the more the
    better the component fits it, and each class votes with the same total. A component without a vote takes the class
    of the example that fits it best."""
    z = (stats - model.centre) / model.scale
    log = model.log_densities(z)
    fit = np.exp((log - np.log(model.weights + 1e-300) - model.log_dets) / z.shape[1])
    votes = model.responsibilities(z) * fit
    by_class = np.stack([votes[labels == c].sum(0) / max(1, (labels == c).sum()) for c in range(len(CLASSES))], axis=1)
    model.classes = np.where(votes.sum(0) >= 0.05, by_class.argmax(1), labels[log.argmax(0)])


def labelled_units(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and class numbers of the units of :data:`EXAMPLES`."""
    row, _, stats = unit_statistics(pa.array([t for _, t in EXAMPLES]), common)
    return stats, np.array([CLASSES.index(c) for c, _ in EXAMPLES])[row]


def measured(rows: DataFrame, common: np.ndarray) -> DataFrame:
    """``doc_id, sizes, stats`` of every text: the visible characters (int32) and the statistics (float32) of its units as
    two packed binaries. Written once, since the fit and the verdict both need them. One row per input row, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, size, stats = unit_statistics(batch.column("text"), common)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows)))).astype(np.int32)
            packed = [
                pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends * np.int32(wide)), pa.py_buffer(x)])
                for wide, x in ((4, size.astype(np.int32)), (4 * len(FEATURES), np.ascontiguousarray(stats, dtype=np.float32)))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *packed], names=["doc_id", "sizes", "stats"])

    return persist_table(rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, sizes binary, stats binary"), "units")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, visible characters and statistics of the units of a batch of :func:`measured`."""
    sizes = batch.column("sizes")
    row = np.repeat(np.arange(len(sizes)), pc.binary_length(sizes).to_numpy() // 4)
    whole = lambda c, kind: np.frombuffer(b"".join(batch.column(c).to_pylist()), kind)
    return row, whole("sizes", np.int32).astype(float), whole("stats", np.float32).reshape(-1, len(FEATURES)).astype(float)


def unit_cells(units: DataFrame) -> DataFrame:
    """Units of all texts counted on the grid, with sums and sums of squares of their statistics. A batch is counted
    before the shuffle, which carries one row per batch and occupied cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, stats = _unpacked(batch)
            if not len(stats):
                continue
            cell, index, n = np.unique(grid_cells(stats), return_inverse=True, return_counts=True)
            sums = [np.bincount(index, x, len(cell)) for x in (*stats.T, *(stats**2).T)]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n), *[pa.array(x) for x in sums]], names=["cell", "n", *moments])

    moments = [f"{kind}{i}" for kind in "sq" for i in range(len(FEATURES))]
    counted = units.select("sizes", "stats").mapInArrow(count, "cell bigint, n bigint, " + ", ".join(f"{m} double" for m in moments))
    return counted.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", *moments)])


def fit_units(units: DataFrame, common: np.ndarray) -> Mixture:
    """Fit over all units; the driver receives one row per occupied grid cell."""
    cells = unit_cells(units).orderBy("cell").toPandas().to_numpy(float)
    stats, labels = labelled_units(common)
    if not len(cells):
        cells = np.concatenate(([0, len(stats)], stats.sum(0), (stats**2).sum(0)))[None]
    d = len(FEATURES)
    model = fit_mixture(cells[:, 1], cells[:, 2 : 2 + d], cells[:, 2 + d :])
    name_components(model, stats, labels)
    return model


def document_classes(df: DataFrame, doc_id: str, text: str, common_words: Sequence[str]) -> DataFrame:
    """Per document: ``n_visible`` characters and the shares of prose, list, table and junk among them, by the mixture.
    Shares are null for texts that show nothing. Rows map one to one; ids may repeat or be null."""
    common = common_hashes(common_words)
    units = measured(spread(df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))), common)
    model = fit_units(units, common)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, size, stats = _unpacked(batch)
            shares = model.class_shares(stats) * size[:, None]
            total = np.bincount(row, size, batch.num_rows)
            with np.errstate(invalid="ignore", divide="ignore"):
                columns = [np.bincount(row, x, batch.num_rows) / total for x in shares.T]
            shown = [pa.array(x, mask=total == 0) for x in columns]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total.astype(np.int64)), *shown], names=["doc_id", "n_visible", *names])

    names = [f"{c}_share" for c in CLASSES]
    return units.mapInArrow(judge, f"doc_id {dict(units.dtypes)['doc_id']}, n_visible bigint, " + ", ".join(f"{c} double" for c in names))


def not_prose(classes: DataFrame, limit: float = 0.50) -> DataFrame:
    """Documents of which the mixture sees more than ``limit`` as other than prose."""
    return classes.where(1 - F.col("prose_share") > limit)


def text_statistics(df: DataFrame, doc_id: str, text: str, common_words: Sequence[str]) -> DataFrame:
    """Words, mean word length, share of symbols, lines, share of lines that end in punctuation, share of common words.

    Native expressions in one pass without a shuffle. Words are runs of letters, digits and combining marks in the text
    as stored; symbols are visible characters that are neither; common words are compared in lower case. Null and blank
    texts have no words and null means and shares.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, r"\r\n|[\n\r]"), lambda x: F.length(F.regexp_replace(x, r"(?U)\s", "")) > 0)
    found = F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{N}\p{M}]+"), F.lit(0))
    base = df.select(
        F.col(doc_id).alias("doc_id"), found.alias("_w"), lines.alias("_l"),
        F.length(F.regexp_replace(t, r"(?U)\s", "")).alias("n_visible"),
        F.length(F.regexp_replace(t, r"(?U)[\s\p{L}\p{N}\p{M}]", "")).alias("_symbols"),
    )
    known = F.array(*[F.lit(w) for w in sorted({w.lower() for w in common_words})]) if common_words else F.array().cast("array<string>")
    words, n_lines = F.size("_w"), F.size("_l")
    letters = F.aggregate("_w", F.lit(0), lambda a, w: a + F.length(w))
    return base.select(
        "doc_id", words.alias("n_words"), "n_visible", n_lines.alias("n_lines"),
        F.try_divide(letters, words).alias("mean_word_length"),
        F.try_divide(F.col("_symbols"), F.col("n_visible")).alias("symbol_share"),
        F.try_divide(F.size(F.filter("_l", lambda x: x.rlike(r"[.!?:;\u2026]\s*$"))), n_lines).alias("ended_lines_share"),
        F.try_divide(F.size(F.filter("_w", lambda w: F.array_contains(known, w))), words).alias("common_share"),
    )
