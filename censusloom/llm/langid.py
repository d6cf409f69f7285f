"""Language of whole texts by a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads a text in segments of a fixed number of bytes, forwards and backwards, and gives every position a
probability of each language; a document's probabilities are the mean over all its positions. It is trained by
backpropagation through time on a bounded sample of labelled passages; reading the whole table is Spark's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from censusloom.llm.text import slices, utf8

UNKNOWN = "und"
#: The training sample: at most this many passages of so many characters for each language.
PASSAGES, PASSAGE = 400, 400
#: How many times as many documents as are needed are ranked.
SLACK = 4
#: Hidden units of each direction, bytes of a segment when reading and when training.
HIDDEN, SEGMENT, TRAINED = 8, 128, 48
STEPS, BATCH, RATE, SEED = 360, 192, 0.02, 7
#: Bytes that are read at a time.
AT_ONCE = 1 << 19


class Network:
    """Gated recurrent units in both directions, and a softmax over languages at every byte."""

    def __init__(self, languages: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        put = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.hidden, self.languages = hidden, languages
        self.weights = {}
        for way in "fb":
            self.weights |= {f"in_{way}": put(256, 3 * hidden), f"back_{way}": put(hidden, 3 * hidden), f"out_{way}": put(hidden, languages)}
        self.weights["out_0"] = np.zeros(languages, np.float32)

    def _cell(self, way: str, byte: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Next state, gates (reset, update), candidate and the state's part of the candidate."""
        n = self.hidden
        into, back = self.weights[f"in_{way}"][byte], state @ self.weights[f"back_{way}"]
        gates = into[:, : 2 * n] + back[:, : 2 * n]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        candidate = gates[:, :n] * back[:, 2 * n :]
        candidate += into[:, 2 * n :]
        np.tanh(candidate, out=candidate)
        step = candidate - state
        step *= gates[:, n:]
        step += state
        return step, gates, candidate, back[:, 2 * n :]

    def _softmax(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        w = self.weights
        p = forward @ w["out_f"] + backward @ w["out_b"] + w["out_0"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def totals(self, buf: np.ndarray, offs: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """Sum of the position probabilities of every text."""
        sizes = np.diff(offs)
        pieces = -(-sizes // segment)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        begin = offs[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * segment
        length = np.minimum(segment, offs[1:][owner] - begin)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        longest = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(longest), "left")  # segments longer than each position
        state, states = np.zeros((len(owner), self.hidden), np.float32), []
        for t in range(longest):
            a = active[t]
            state = self._cell("f", buf[begin[:a] + t], state[:a])[0]
            states.append(state)
        total = np.zeros((len(owner), self.languages), np.float32)
        state = np.zeros((len(owner), self.hidden), np.float32)
        for t in reversed(range(longest)):
            a = active[t]
            state[:a] = self._cell("b", buf[begin[:a] + t], state[:a])[0]
            total[:a] += self._softmax(states.pop(), state[:a])
        out = np.zeros((len(sizes), self.languages))
        for k in range(self.languages):
            out[:, k] = np.bincount(owner, weights=total[:, k], minlength=len(sizes))
        return out

    def _gradients(self, batch: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean cross entropy over all positions, by backpropagation through time."""
        n, (rows, size), w = self.hidden, batch.shape, self.weights
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        seen = {}
        for way, times in (("f", range(size)), ("b", range(size - 1, -1, -1))):
            state, steps = np.zeros((rows, n), np.float32), {}
            for t in times:
                after, gates, candidate, recurrent = self._cell(way, batch[:, t], state)
                steps[t] = (state, after, gates, candidate, recurrent)
                state = after
            seen[way] = steps
        errors = []
        for t in range(size):
            p = self._softmax(seen["f"][t][1], seen["b"][t][1])
            p[np.arange(rows), label] -= 1
            p /= rows * size
            errors.append(p)
            for way in "fb":
                grads[f"out_{way}"] += seen[way][t][1].T @ p
            grads["out_0"] += p.sum(axis=0)
        for way, times in (("f", range(size - 1, -1, -1)), ("b", range(size))):
            carried = np.zeros((rows, n), np.float32)
            back = w[f"back_{way}"]
            for t in times:
                state, _, gates, candidate, recurrent = seen[way][t]
                reset, update = gates[:, :n], gates[:, n:]
                d = carried + errors[t] @ w[f"out_{way}"].T
                d_candidate = d * update * (1 - candidate**2)
                d_update = d * (candidate - state) * update * (1 - update)
                d_reset = d_candidate * recurrent * reset * (1 - reset)
                inner = np.concatenate((d_reset, d_update, d_candidate * reset), axis=1)
                grads[f"back_{way}"] += state.T @ inner
                outer = np.concatenate((d_reset, d_update, d_candidate), axis=1)
                np.add.at(grads[f"in_{way}"], batch[:, t], outer)
                carried = d * (1 - update) + inner @ back.T
        return grads

    def train(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> None:
        """Adam steps on random segments; every language has the same part in a batch."""
        rng = np.random.default_rng(seed)
        by = [np.flatnonzero(labels == k) for k in range(self.languages)]
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            label = rng.integers(0, self.languages, BATCH)
            batch = np.zeros((BATCH, TRAINED), np.uint8)
            for row, k in enumerate(label):
                text = texts[by[k][rng.integers(len(by[k]))]]
                at = int(rng.integers(max(1, len(text) - TRAINED + 1)))
                cut = text[at : at + TRAINED]
                cut = (cut * (TRAINED // len(cut) + 1))[:TRAINED]
                batch[row] = np.frombuffer(cut, np.uint8)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in self._gradients(batch, label).items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                self.weights[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text is divisible by 5; such rows are never learnt from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(df: DataFrame, text: str, label: str, key: str) -> list[tuple[str, bytes]]:
    """(label, passage) rows: for each label the documents of least hash, one passage from a hashed place of each.

    Equal passages of one key count once.

    From the counts of the labels follows a hash below which about four times as many documents lie as are needed; so
    a label's task sees some thousand rows, however many there are. Where these do not suffice (few of a label's texts
    have a letter), all its rows are ranked.
    """
    at = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.greatest(F.length(text) - PASSAGE, F.lit(1))).cast("int") + 1
    known = df.where(F.col(label).isNotNull() & ~held_out(F.col(key)))
    counts = {r["label"]: r["n"] for r in known.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = known.where(F.col(text).isNotNull()).select(
        F.col(label).alias("label"), F.substring(F.col(text), at, F.lit(PASSAGE)).alias("passage"), F.xxhash64(key).alias("hash")
    )
    rows = rows.where(F.col("passage").rlike("\\p{L}"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("hash", "passage"))
    found: list[tuple[str, bytes]] = []
    todo = {name: min(1.0, SLACK * PASSAGES / n) for name, n in counts.items()}
    while todo:
        # The labels are those the network tells apart, so their list is short.
        limits = F.create_map(*[F.lit(x) for name, part in todo.items() for x in (name, _hash_below(part))])
        kept = rows.where(F.col("hash") <= F.element_at(limits, F.col("label"))).distinct().withColumn("rank", rank).where(F.col("rank") <= PASSAGES)
        got: dict[str, list[bytes]] = {name: [] for name in todo}
        for r in kept.select("label", "passage").collect():
            got[r["label"]].append(r["passage"].encode())
        done = [name for name, part in todo.items() if part == 1.0 or len(got[name]) == PASSAGES]
        found += [(name, passage) for name in done for passage in got[name]]
        todo = {name: 1.0 for name in todo if name not in done}
    return sorted(found)


def _hash_below(part: float) -> int:
    """The 64-bit number below which a part of all hashes lies."""
    return (1 << 63) - 1 if part >= 1.0 else -(1 << 63) + int(part * (1 << 64))


def fit(passages: list[tuple[str, bytes]]) -> tuple[list[str], Network | None]:
    languages = sorted({label for label, _ in passages})
    if not languages:
        return [], None
    network = Network(len(languages))
    network.train([t for _, t in passages], np.array([languages.index(label) for label, _ in passages]))
    return languages, network


def predict_language(df: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> DataFrame:
    """key, held_out, lang_pred and score for every row.

    Null texts and texts without a letter are "und" with score 0, and so is everything if no row is labelled. A null
    key counts as held out. Repeated rows give repeated results. Only text, label and key are read, label for training
    only.
    """
    languages, network = fit(sample(df, text, label, key))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = utf8(batch.column(3))
            readable = np.array(batch.column(2).to_pylist(), bool)
            names, scores = [], np.zeros(batch.num_rows)
            for i, j in slices(offs, AT_ONCE):
                if network is None:
                    names += [UNKNOWN] * (j - i)
                    continue
                total = network.totals(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                best = total.argmax(axis=1)
                share = total[np.arange(j - i), best] / np.maximum(np.diff(offs[i : j + 1]), 1)
                names += [languages[k] if ok else UNKNOWN for k, ok in zip(best, readable[i:j], strict=True)]
                scores[i:j] = np.where(readable[i:j], np.clip(share, 0, 1), 0)
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "held_out", "lang_pred", "score"])

    rows = df.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias("readable"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("key", key)
