"""Language identification by a bidirectional gated recurrent network over bytes.

The network labels every byte of a text from both sides; a text's probabilities are the mean over
its bytes. Whole texts are read, in windows of ``STEPS`` bytes that run side by side. It is fitted on
the driver in numpy, on a bounded sample of labelled rows: about ``PER_LABEL`` rows of each
language, with ``PIECES`` pieces of ``PIECE`` characters from each. Every language is learned; if there are
many, there are fewer rows of each, ``MOST_ROWS`` in all but one at least.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import recurrent as R
from cadastra.llm.common import bounded, bucket_of, sized, slices
from cadastra.llm.words import text_bytes
from cadastra.session import pin

UNITS = 12
STEPS = 128
WIDE = 2048
PER_LABEL = 300
PIECES = 4
PIECE = 200
MOST_ROWS = 64 * PER_LABEL
# Labels up to which windows and batches have their full width, and rounds are not added.
FULL_WIDTH = 64
MOST_MORE = 4
ROUNDS = 400
BATCH = 128
TRAIN_STEPS = 64
FOLDS = 5
HELD_OUT = 0
NONE = "und"
LETTER = re.compile(r"[^\W\d_]")


def sample(docs: DataFrame, per_label: int = PER_LABEL) -> pd.DataFrame:
    """Pieces of text with their language: rows outside the held-out fold, of each language a share
    by id hash that gives about ``per_label`` rows, and evenly spaced pieces of each."""
    rows = docs.filter((bucket_of("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & (F.length("text") > 0))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("language"), F.col("doc_id")), 11) / float(1 << 53)
    # One row per language.
    counts = pin(rows.groupBy("lang").agg(F.count("*").alias("rows"), F.min(draw).alias("least")))
    languages = counts.count()
    if not languages:
        return pd.DataFrame({"lang": [], "piece": []})
    per_label = max(1, min(per_label, MOST_ROWS // languages))
    shares = counts.select(F.col("lang").alias("known"), (F.lit(per_label) / F.col("rows")).alias("share"), "least")
    step = F.greatest(F.lit(1), F.floor((F.length("text") - PIECE) / PIECES))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda i: F.substring(F.col("text"), (i * step + 1).cast("int"), F.lit(PIECE)),
    )
    # The row of the least draw stands for a language whose share gives none.
    drawn = rows.join(sized(shares, languages), F.col("lang") == F.col("known")).filter((draw < F.col("share")) | (draw == F.col("least")))
    chosen = drawn.select("lang", F.explode(F.array_distinct(pieces)).alias("piece"))
    # About per_label * PIECES rows of PIECE characters for each language.
    return chosen.orderBy(F.xxhash64("piece")).limit(2 * per_label * PIECES * languages).toPandas()


class Network:
    """Byte tables and recurrent weights of both directions, and the label layer."""

    def __init__(self, labels: list[str], units: int = UNITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.units = labels, units
        self.params = R.init(rng, units) | {
            "Tf": (0.3 * rng.standard_normal((3 * units, 256))).astype(np.float32),
            "Tb": (0.3 * rng.standard_normal((3 * units, 256))).astype(np.float32),
            "V": (0.3 * rng.standard_normal((len(labels), 2 * units))).astype(np.float32),
            "c": np.zeros((len(labels), 1), np.float32),
        }

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        logits = logits - logits.max(axis=-2, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(axis=-2, keepdims=True)

    def step(self, symbols: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions, and the gradients."""
        p, units = self.params, self.units
        ahead, kept_f = R.trace(p["Tf"], p["Uf"], symbols, mask, False)
        behind, kept_b = R.trace(p["Tb"], p["Ub"], symbols, mask, True)
        states = np.concatenate((ahead, behind), axis=1)
        chance = self._softmax(np.matmul(p["V"], states) + p["c"])
        picked = np.take_along_axis(chance, target[None, None, :], axis=1)[:, 0]
        total = mask.sum()
        loss = -(np.log(picked + 1e-9) * mask).sum() / total
        error = chance
        np.put_along_axis(error, np.broadcast_to(target[None, None, :], (len(chance), 1, len(target))), (picked - 1)[:, None], axis=1)
        error *= (mask / total)[:, None, :]
        grads = {
            "V": np.einsum("tcb,tub->cu", error, states, optimize=True), "c": error.sum(axis=(0, 2))[:, None],
        }
        flow = np.matmul(p["V"].T, error)
        inputs, grads["Uf"] = R.back(flow[:, :units], kept_f, p["Uf"], mask, False)
        grads["Tf"] = R.by_symbol(inputs, symbols, 256)
        inputs, grads["Ub"] = R.back(flow[:, units:], kept_b, p["Ub"], mask, True)
        grads["Tb"] = R.by_symbol(inputs, symbols, 256)
        return float(loss), grads

    def pooled(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mean label probabilities (texts, labels) over all bytes of each text."""
        p, units = self.params, self.units
        starts, lengths, text = R.windows(ends, STEPS, STEPS)
        sums = np.zeros((len(ends), len(self.labels)))
        order = np.argsort(-lengths, kind="stable")
        padded = np.concatenate((data, np.zeros(STEPS, np.uint8)))
        steps = np.arange(STEPS)[:, None]
        front, rear = p["V"][:, :units], p["V"][:, units:]
        # Probabilities of all labels are held for as many windows as keep them bounded.
        wide = max(16, WIDE * FULL_WIDTH // max(FULL_WIDTH, len(self.labels)))
        for at in range(0, len(order), wide):
            some = order[at : at + wide]
            symbols = padded[starts[some][None, :] + steps]
            full = lengths[some[-1]] == STEPS
            mask = None if full else (steps < lengths[some][None, :]).astype(np.float32)
            logits = np.matmul(front, R.scan(p["Tf"], p["Uf"], symbols, mask, False))
            logits += np.matmul(rear, R.scan(p["Tb"], p["Ub"], symbols, mask, True))
            logits += p["c"]
            chance = self._softmax(logits)
            found = chance.sum(axis=0) if full else (chance * mask[:, None, :]).sum(axis=0)
            np.add.at(sums, text[some], found.T)
        sizes = np.diff(np.concatenate(([0], ends)))
        return sums / np.maximum(sizes, 1)[:, None]


def train(pieces: list[bytes], names: list[str], rounds: int | None = None, seed: int = 7) -> Network | None:
    """Fit on labelled pieces; every language is drawn equally often, with more rounds (``MOST_MORE`` times
    as many at most) if there are more than ``FULL_WIDTH``. None without any piece."""
    pairs = sorted((p, n) for p, n in zip(pieces, names, strict=True) if p)
    if not pairs:
        return None
    labels = sorted({n for _, n in pairs})
    network = Network(labels, seed=seed)
    rng = np.random.default_rng(seed)
    by_name: dict[str, list[np.ndarray]] = {label: [] for label in labels}
    for p, n in pairs:
        by_name[n].append(np.frombuffer(p, np.uint8))
    by_label = list(by_name.values())
    rounds = rounds or ROUNDS * min(MOST_MORE, max(1, -(-len(labels) // FULL_WIDTH)))
    batch = max(16, min(BATCH, BATCH * 16 * FULL_WIDTH // len(labels)))
    adam = R.Adam(network.params, 0.02)
    for turn in range(rounds):
        target = rng.integers(0, len(labels), batch)
        symbols = np.zeros((TRAIN_STEPS, batch), np.uint8)
        mask = np.zeros((TRAIN_STEPS, batch), np.float32)
        for column, label in enumerate(target):
            piece = by_label[label][rng.integers(len(by_label[label]))]
            start = rng.integers(0, max(1, len(piece) - TRAIN_STEPS + 1))
            part = piece[start : start + TRAIN_STEPS]
            symbols[: len(part), column] = part
            mask[: len(part), column] = 1
        _, grads = network.step(symbols, mask, target)
        adam.update(grads, 0.02 * (1 - 0.9 * turn / rounds))
    return network


def fit(docs: DataFrame) -> Network | None:
    found = sample(docs)
    return train([p.encode() for p in found["piece"]], list(found["lang"]))


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs`` (doc_id, text).

    score is the mean probability of the predicted language over the bytes of the whole text. A
    text that is null or has no letters is ``und`` with score 0, as is every text if there was
    nothing to learn from. A null id counts as empty text in the fold (held out). Repeated rows stay;
    other columns are ignored. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                lettered = np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
                names, scores = np.full(len(texts), NONE, object), np.zeros(len(texts))
                if model is not None and lettered.any():
                    chance = model.pooled(*text_bytes(texts))
                    best = chance.argmax(axis=1)
                    names[lettered] = np.array(model.labels, object)[best[lettered]]
                    scores[lettered] = np.clip(chance.max(axis=1)[lettered], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"],
                )

    found = bounded(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", (bucket_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
