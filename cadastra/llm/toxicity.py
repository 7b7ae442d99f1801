"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

Inputs are words: each word brings an embedding of its own and the embeddings of its character
groups (3 and 4 bytes, with marks for its ends). The network reads windows of ``STEPS`` words that
overlap by half; attention pools the states and inputs of a window into one logit. A text's score
is that of its worst window, and every window of the whole text is scored. It is fitted on the
driver in numpy, on a bounded sample of labelled rows: about ``PER_CLASS`` rows of each label, whatever
the length of their texts. Of a text above ``MOST_CHARS`` characters a random run of so many is taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm import recurrent as R
from cadastra.llm import words as W
from cadastra.llm.common import bounded, bucket_of, slices
from cadastra.session import pin

UNITS = 12
WIDTH = 16
STEPS = 64
STRIDE = 32
WIDE = 1024
BUCKETS = 1 << 17
LEAST_TEXTS = 4
PER_CLASS = 1000
MOST_CHARS = 8000
ROUNDS = 150
BATCH = 24
MOST_WINDOWS = 12
DOUBT = -1.0
DECAY = 0.003
FOLDS = 3
HELD_OUT = 1
THRESHOLD = 0.7
SLICE = 1 << 20

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> pd.DataFrame:
    """text and toxic of labelled rows outside the held-out fold: of each label a share by id hash
    that gives about ``per_class`` of the ids that have a text. A document with several labels counts as
    toxic if one is; of several rows of an id one is drawn. Long texts are represented by a random run."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (bucket_of("doc_id", FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    written = docs.select("doc_id", "text").filter(F.length("text") > 0)
    # Labels of ids without text teach nothing, so they do not count.
    known = pin(known.join(written.select("doc_id"), "doc_id", "left_semi"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts:
        return pd.DataFrame({"text": [], "toxic": []})
    draw = _draw("toxicity", "doc_id")
    share = F.lit(0.0)
    for label, rows in counts.items():
        share = F.when(F.col("toxic") == label, min(1.0, per_class / rows)).otherwise(share)
    # About 2 * per_class ids, whatever the input; the limit is the bound in the unlikely rest.
    chosen = known.filter(draw < share).orderBy(draw).limit(4 * per_class)
    spare = F.greatest(F.lit(0), F.length("text") - MOST_CHARS)
    run = F.substring(F.col("text"), (F.floor(_draw("run", "doc_id", "text") * (spare + 1)) + 1).cast("int"), F.lit(MOST_CHARS))
    found = written.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", run.alias("text"), _draw("row", "text").alias("at"))
    one = found.groupBy("doc_id", "toxic").agg(F.min(F.struct("at", "text"))["text"].alias("text"))
    return one.toPandas().sort_values("doc_id", ignore_index=True)[["text", "toxic"]]


def _draw(name: str, *columns: str) -> Column:
    """A number from 0 to 1 by the hash of some columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(name), *columns), 11) / float(1 << 53)


class Words:
    """The words of some texts: hash numbers, and for each distinct word its character groups."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        data = LOWER[data]
        starts, stops, self.text = W.words(data, ends, LETTERS)
        hashes = W.word_hashes(data, starts, stops)
        found, first, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.ends = np.searchsorted(self.text, np.arange(len(ends)), side="right")
        self.word = (found >> np.uint64(20)).astype(np.int64) % BUCKETS
        self.group, self.owner = _groups(data, starts[first], stops[first])

    @property
    def distinct(self) -> int:
        return len(self.word)


def _groups(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of the 3- and 4-byte groups of ^word$."""
    sizes = stops - starts + 2
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(starts)), sizes)
    inside = np.arange(len(owner)) - (ends - sizes)[owner]
    source = np.clip(starts[owner] + inside - 1, 0, max(0, len(data) - 1))
    marked = data[source].astype(np.uint64) + np.uint64(2) if len(data) else np.zeros(0, np.uint64)
    marked[inside == 0] = 0
    marked[inside == sizes[owner] - 1] = 1
    buckets, owners = [], []
    for size in (3, 4):
        count = max(0, len(marked) - size + 1)
        whole = owner[:count] == owner[size - 1 :][:count]
        code = np.full(count, size, np.uint64)
        for i in range(size):
            code = code * np.uint64(259) + marked[i : i + count]
        buckets.append((W.mix(code[whole]) >> np.uint64(20)).astype(np.int64) % BUCKETS)
        owners.append(owner[:count][whole])
    return np.concatenate(buckets), np.concatenate(owners)


class Network:
    """Embeddings of the known words and character groups, and the weights above them."""

    def __init__(self, word_rows: np.ndarray, group_rows: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        # Row of the embeddings for each bucket; what is not known has the last row.
        self.word_at = self._places(word_rows)
        self.group_at = self._places(group_rows)
        small = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
        deep = 2 * UNITS + WIDTH
        self.params = R.init(rng, UNITS) | {
            # The last row stands for words and groups that are not known; it stays zero.
            "Ew": small(len(word_rows) + 1, WIDTH), "Ec": small(len(group_rows) + 1, WIDTH),
            "Wf": small(3 * UNITS, WIDTH + 1) * 3, "Wb": small(3 * UNITS, WIDTH + 1) * 3,
            "A": small(WIDTH, deep) * 3, "q": small(1, WIDTH) * 3,
            "w": small(1, deep) * 3, "b": np.full((1, 1), -1.0, np.float32),
        }
        self.params["Ew"][-1] = 0
        self.params["Ec"][-1] = 0

    @staticmethod
    def _places(rows: np.ndarray) -> np.ndarray:
        places = np.full(BUCKETS, len(rows), np.int32)
        places[rows] = np.arange(len(rows))
        return places

    def inputs(self, words: Words):
        """(x: (distinct words, WIDTH), what is needed for its gradient)."""
        word, group = self.word_at[words.word], self.group_at[words.group]
        counts = np.bincount(words.owner, minlength=words.distinct)
        scale = (1 / np.sqrt(np.maximum(counts, 1))).astype(np.float32)
        known = group < len(self.params["Ec"]) - 1
        group, owner = group[known], words.owner[known]
        x = self.params["Ew"][word]
        if len(group):
            values = self.params["Ec"][group]
            begin = np.flatnonzero(np.diff(owner, prepend=-1))
            # Groups of one size lie together, so a word has at most two runs of groups.
            np.add.at(x, owner[begin], np.add.reduceat(values, begin, axis=0) * scale[owner[begin]][:, None])
        return x, (word, group, owner, scale)

    def tables(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with_bias = np.concatenate((x, np.ones((len(x), 1), np.float32)), axis=1).T
        return self.params["Wf"] @ with_bias, self.params["Wb"] @ with_bias

    def pool(self, ahead, behind, x, symbols, mask):
        """Attention over the positions of each window: (deep states, tanh layer, shares, context)."""
        deep = np.concatenate((ahead, behind, x.T[:, symbols].transpose(1, 0, 2)), axis=1)
        layer = np.tanh(np.matmul(self.params["A"], deep))
        marks = np.matmul(self.params["q"], layer)[:, 0] + (mask - 1) * 1e4
        marks = np.exp(marks - marks.max(axis=0))
        shares = marks / marks.sum(axis=0)
        return deep, layer, shares, np.einsum("tb,tdb->db", shares, deep, optimize=True)

    def step(self, words: Words, windows, toxic: np.ndarray, doubt: float = -np.inf) -> tuple[float, dict]:
        """Loss and gradients of some texts; ``windows``: (start, length, text) of their windows.

        A clean text teaches that each of its windows is clean, a toxic one that one of them at
        least is not (the soft maximum of its logits). A toxic text whose soft maximum is below
        ``doubt`` is taken for wrongly labelled and teaches nothing.
        """
        p = self.params
        starts, lengths, text = windows
        steps = np.arange(STEPS)[:, None]
        mask = (steps < lengths[None, :]).astype(np.float32)
        padded = np.concatenate((words.number, np.zeros(STEPS, np.int64)))
        symbols = padded[starts[None, :] + steps]
        x, (word, group, owner, scale) = self.inputs(words)
        tf, tb = self.tables(x)
        ahead, kept_f = R.trace(tf, p["Uf"], symbols, mask, False)
        behind, kept_b = R.trace(tb, p["Ub"], symbols, mask, True)
        deep, layer, shares, context = self.pool(ahead, behind, x, symbols, mask)
        logits = (p["w"] @ context + p["b"])[0]
        share, loss = np.zeros(len(logits), np.float32), 0.0
        texts = np.unique(text)
        for t in texts:
            mine = np.flatnonzero(text == t)
            z = np.clip(logits[mine], -30, 30)
            if toxic[t]:
                top = z.max()
                weight = np.exp(z - top)
                total = top + np.log(weight.sum())
                if total < doubt:
                    continue
                loss += np.log1p(np.exp(-total))
                share[mine] = -weight / weight.sum() / (1 + np.exp(total))
            else:
                loss += np.log1p(np.exp(z)).mean() + np.log1p(np.exp(z.max()))
                chance = 1 / (1 + np.exp(-z))
                share[mine] = chance / len(mine)
                share[mine[z.argmax()]] += chance[z.argmax()]
        share /= len(texts)
        grads = {"w": share[None, :] @ context.T, "b": share.sum().reshape(1, 1)}
        flow_context = p["w"].T @ share[None, :]
        flow_deep = shares[:, None, :] * flow_context[None]
        flow_share = np.einsum("db,tdb->tb", flow_context, deep, optimize=True)
        flow_mark = shares * (flow_share - (shares * flow_share).sum(axis=0))
        grads["q"] = np.einsum("tb,tab->a", flow_mark, layer, optimize=True)[None]
        flow_layer = p["q"].T[None] * flow_mark[:, None, :] * (1 - layer * layer)
        grads["A"] = np.einsum("tab,tdb->ad", flow_layer, deep, optimize=True)
        flow_deep = flow_deep + np.matmul(p["A"].T, flow_layer)
        flow_x = R.by_symbol(flow_deep[:, 2 * UNITS :], symbols, words.distinct).T
        with_bias = np.concatenate((x, np.ones((len(x), 1), np.float32)), axis=1)
        for name, part, kept, reverse in (("f", flow_deep[:, :UNITS], kept_f, False), ("b", flow_deep[:, UNITS : 2 * UNITS], kept_b, True)):
            inputs, grads["U" + name] = R.back(part, kept, p["U" + name], mask, reverse)
            table = R.by_symbol(inputs, symbols, words.distinct)
            grads["W" + name] = table @ with_bias
            flow_x = flow_x + table.T @ p["W" + name][:, :WIDTH]
        grads["Ew"], grads["Ec"] = np.zeros_like(p["Ew"]), np.zeros_like(p["Ec"])
        np.add.at(grads["Ew"], word, flow_x)
        np.add.at(grads["Ec"], group, flow_x[owner] * scale[owner][:, None])
        grads["Ew"][-1] = 0
        grads["Ec"][-1] = 0
        return float(loss / len(texts)), grads

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Probability of the worst window of each text; a text without words has the score of an
        empty window (the bias alone)."""
        p = self.params
        words = Words(data, ends)
        worst = np.full(len(ends), -np.inf, np.float32)
        starts, lengths, text = R.windows(words.ends, STEPS, STRIDE)
        if len(starts):
            x, _ = self.inputs(words)
            tf, tb = self.tables(x)
            padded = np.concatenate((words.number, np.zeros(STEPS, np.int64)))
            steps = np.arange(STEPS)[:, None]
            order = np.argsort(-lengths, kind="stable")
            for at in range(0, len(order), WIDE):
                some = order[at : at + WIDE]
                symbols = padded[starts[some][None, :] + steps]
                mask = (steps < lengths[some][None, :]).astype(np.float32)
                full = None if lengths[some[-1]] == STEPS else mask
                ahead = R.scan(tf, p["Uf"], symbols, full, False)
                behind = R.scan(tb, p["Ub"], symbols, full, True)
                *_, context = self.pool(ahead, behind, x, symbols, mask)
                np.maximum.at(worst, text[some], (p["w"] @ context + p["b"])[0])
        worst[np.isinf(worst)] = min(0.0, float(p["b"][0, 0]))
        return 1 / (1 + np.exp(-np.clip(worst.astype(np.float64), -30, 30)))


class Constant:
    """The score of every text where only one label, or none, was given."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.full(len(ends), self.score)


def train(texts: list[str], toxic: list[int], rounds: int = ROUNDS, seed: int = 11) -> Network | Constant:
    """Fit on labelled texts; half of each batch is toxic."""
    labels = np.array(toxic, dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels.mean()) if len(labels) else 0.0)
    every = Words(*W.text_bytes(pa.array(texts, pa.string())))
    network = Network(*_known(every, len(texts)), seed)
    rng = np.random.default_rng(seed)
    adam = R.Adam(network.params, 0.02)
    pools = [np.flatnonzero(labels == 0), np.flatnonzero(labels == 1)]
    for turn in range(rounds):
        chosen = np.concatenate([rng.choice(pool, BATCH) for pool in pools])
        words = Words(*W.text_bytes(pa.array([texts[i] for i in chosen], pa.string())))
        starts, lengths, text = R.windows(words.ends, STEPS, STRIDE)
        if not len(starts):
            continue
        doubt = DOUBT if turn > rounds // 2 else -np.inf
        # A random run of windows of the longer texts, at most MOST_WINDOWS of a text.
        counts = np.bincount(text, minlength=len(chosen))
        nth = np.arange(len(text)) - (np.cumsum(counts) - counts)[text]
        skip = rng.integers(0, np.maximum(1, counts - MOST_WINDOWS + 1))
        keep = (nth >= skip[text]) & (nth < skip[text] + MOST_WINDOWS)
        _, grads = network.step(words, (starts[keep], lengths[keep], text[keep]), labels[chosen], doubt)
        adam.update(grads, 0.02 * (1 - 0.9 * turn / rounds))
        for name in ("Ew", "Ec"):
            network.params[name] *= 1 - DECAY
    return network


def _known(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of character groups that occur in at least LEAST_TEXTS texts."""
    pairs = np.unique(words.number.astype(np.int64) * texts + words.text)
    number, text = pairs // texts, pairs % texts
    rows = []
    for bucket, owner in ((words.word, np.arange(words.distinct)), (words.group, words.owner)):
        order = np.argsort(owner, kind="stable")
        sizes = np.bincount(owner, minlength=words.distinct)
        begin = np.cumsum(sizes) - sizes
        reps = sizes[number]
        spot = np.repeat(begin[number], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        seen = np.unique(bucket[order][spot] * texts + np.repeat(text, reps))
        found, times = np.unique(seen // texts, return_counts=True)
        rows.append(found[times >= LEAST_TEXTS])
    return rows[0], rows[1]


def fit(docs: DataFrame, labels: DataFrame) -> Network | Constant:
    """A classifier of the labelled rows outside the held-out fold."""
    rows = sample(docs, labels)
    return train(list(rows["text"]), list(rows["toxic"]))


def predict(docs: DataFrame, network: Network | Constant) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    A null or empty text, or one without words, gets the score of no evidence, at most 0.5. Without
    labels every score is 0, with one label only it is that label. A null id counts as empty text in
    the fold. Repeated rows stay; other columns are ignored. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                scores = shared.value.scores(*W.text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    found = bounded(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, score double")
    return found.select(
        "doc_id",
        (bucket_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, network: Network | Constant) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        column = pa.RecordBatch.from_arrays([pa.array(text, pa.string())], ["text"])
        parts = [shared.value.scores(*W.text_bytes(p.column("text"))) for p in slices(column, "text", SLICE)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return bounded(docs).filter(score("text") < THRESHOLD)
