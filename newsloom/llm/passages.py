"""Quality classifier: attention over passages, learned from labels of whole documents.

A text is cut into passages of ``PASSAGE`` words. Every passage of every text is encoded as a vector:
shares of byte classes and of their pairs, of hashed words, and how words repeat. A gated attention
layer weighs the passages of a document; the weighted sum of their hidden vectors is scored. Only
documents carry labels, so the attention learns which passages tell (multiple-instance learning).

Training takes a bounded sample of labelled documents, chosen by a hash of their id: at most
``TRAIN_DOCS``, and as many of them as have ``TRAIN_PASSAGES`` passages together (the first one
whatever it has). All passages of a document that is taken are encoded and trained on. Scoring reads
all passages of all texts. Ids, labels, language and source are no inputs of a score.

A text above ``BLOCK`` bytes is encoded in pieces that begin where a passage does, so that memory
follows its length with a small factor (some 10 bytes for each of its bytes, mostly the vectors).

Defined cases: null and empty texts have one passage without words and are scored like others; a
document with several labels has the smaller; null labels are no labels; without labels, or with
one kind only, every score is the labels' share of ones (0.5 without any); rows that repeat a
``doc_id`` come back as often; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize

PASSAGE = 64
TRAIN_DOCS = 4000
TRAIN_PASSAGES = 60_000

#: Texts are encoded in blocks of about so many bytes.
BLOCK = 1 << 20

HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 12, 64, 3e-3, 1e-4
SEED = 11

WORD_BINS = 64

# Byte classes: small letter, capital, digit, blank, line feed, full stop, comma, ! or ?, symbols,
# quotes and brackets, other ASCII, first and following bytes beyond ASCII.
N_CLASSES = 13


def _class_table() -> np.ndarray:
    table = np.full(256, 10, np.int64)
    for number, chars in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".", b",", b"!?", b"#*$%&|<>", b"\"'()[]{}")
    ):
        table[list(chars)] = number
    table[0xC0:] = 11
    table[0x80:0xC0] = 12
    return table


CLASSES = _class_table()
IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Random numbers by which words are hashed: one for each byte, one for each place in the word.
_random = np.random.default_rng(SEED)
BYTE_HASH = _random.integers(1, 2**63, 256, np.uint64)
PLACE_HASH = _random.integers(0, 2**62, 256, np.uint64) * np.uint64(2) + np.uint64(1)

N_OWN = 8
WIDTH = N_CLASSES + N_CLASSES**2 + WORD_BINS + N_OWN


def encode(texts: list[bytes], words_in_all: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A vector for every passage of the texts, and each passage's text number.

    ``words_in_all`` counts the words of the text that each one is a piece of.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    text_start = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    space = IS_SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    first_word = np.searchsorted(starts, text_start)
    n_words = np.diff(first_word)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    first_passage = np.concatenate(([0], np.cumsum(n_passages)))
    total = first_passage[-1]
    owner = np.repeat(np.arange(len(texts)), n_passages)
    word_text = np.repeat(np.arange(len(texts)), n_words)
    word_passage = first_passage[word_text] + (np.arange(len(starts)) - first_word[word_text]) // PASSAGE

    # Bytes belong to the passage of the last word that began; those before the first word to the first.
    cut_at = np.concatenate((text_start[:-1], starts))
    cut_to = np.concatenate((first_passage[:-1], word_passage))
    order = np.lexsort((np.concatenate((np.zeros(len(texts)), np.ones(len(starts)))), cut_at))
    at, to = cut_at[order], cut_to[order]
    byte_passage = np.repeat(to, np.diff(np.concatenate((at, [len(data)]))))
    kind = CLASSES[data]
    shares = np.bincount(byte_passage * N_CLASSES + kind, minlength=total * N_CLASSES).reshape(total, -1)
    n_bytes = np.maximum(1, shares.sum(axis=1, keepdims=True))
    pair = byte_passage[:-1] * N_CLASSES**2 + kind[:-1] * N_CLASSES + kind[1:]
    # What stands between two texts is followed by nothing, so that a text's vectors don't depend on the next one.
    inside = np.ones(len(pair), bool)
    inside[text_start[1:-1] - 1] = False
    pairs = np.bincount(pair[inside], minlength=total * N_CLASSES**2).reshape(total, -1)

    if len(starts):
        place = np.zeros(len(data), np.int64)
        place[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        value = np.where(space, np.uint64(0), BYTE_HASH[data] * PLACE_HASH[place % 256])
        word = np.add.reduceat(value, starts)
        word ^= word >> np.uint64(29)
        length = np.add.reduceat(~space, starts, dtype=np.int64)
        capital = np.add.reduceat(kind == 1, starts, dtype=np.int64)
    else:
        word = length = capital = np.zeros(0, np.int64)

    def per_passage(values: np.ndarray, number: np.ndarray = word_passage) -> np.ndarray:
        return np.bincount(number, values, minlength=total)

    words = np.maximum(1, np.bincount(word_passage, minlength=total))
    bins = np.bincount(
        word_passage * WORD_BINS + (word % np.uint64(WORD_BINS)).astype(np.int64), minlength=total * WORD_BINS
    ).reshape(total, -1)

    def repeats(step: int) -> np.ndarray:
        same = (word[step:] == word[:-step]) & (word_passage[step:] == word_passage[:-step])
        return per_passage(same, word_passage[step:]) / words

    by_word = np.lexsort((word, word_passage))
    sorted_word, sorted_passage = word[by_word], word_passage[by_word]
    fresh = np.ones(len(word), bool)
    fresh[1:] = (sorted_word[1:] != sorted_word[:-1]) | (sorted_passage[1:] != sorted_passage[:-1])
    own = np.stack(
        [
            repeats(1),
            repeats(2),
            per_passage(fresh, sorted_passage) / words,
            per_passage(length) / words / 10,
            per_passage((capital > 1) & (2 * capital > length)) / words,
            per_passage(length > 20) / words,
            np.bincount(word_passage, minlength=total) / PASSAGE,
            np.log1p((n_words if words_in_all is None else words_in_all)[owner]) / 10,
        ],
        axis=1,
    )
    vectors = np.concatenate((shares / n_bytes, pairs / n_bytes, bins / words[:, None], own), axis=1)
    return vectors.astype(np.float32), owner


def pieces(text: bytes) -> tuple[list[bytes], int]:
    """A long text cut where a passage begins, in pieces of about ``BLOCK`` bytes, and the number of its words."""
    found, begun, words, open_word, at = [], 0, 0, False, 0
    for start in range(0, len(text), BLOCK):
        space = IS_SPACE[np.frombuffer(text, np.uint8, min(BLOCK, len(text) - start), start)]
        first = np.flatnonzero(~space & np.concatenate(([not open_word], space[:-1]))) + start
        # Of the words that begin here, the first one with which a passage begins.
        k = -words % PASSAGE
        if k < len(first) and words + k and first[k] > at:
            found.append(text[begun : first[k]])
            begun = int(first[k])
        words, open_word, at = words + len(first), not space[-1], begun
    return [*found, text[begun:]], words


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``encode`` in blocks of bounded size, a document whole; text numbers count from the first text."""
    held: list[bytes] = []
    done = size = 0

    def encoded() -> tuple[np.ndarray, np.ndarray]:
        vectors, owner = encode(held)
        return vectors, owner + done

    for text in texts:
        spelt = (text or "").encode()
        if len(spelt) > BLOCK:
            if held:
                yield encoded()
                done, held, size = done + len(held), [], 0
            cut, words = pieces(spelt)
            vectors = np.concatenate([encode([piece], np.array([words]))[0] for piece in cut])
            yield vectors, np.full(len(vectors), done)
            done += 1
            continue
        held.append(spelt)
        size += len(spelt)
        if size >= BLOCK:
            yield encoded()
            done, held, size = done + len(held), [], 0
    if held:
        yield encoded()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Gated attention over the passages of a document."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for passages ``x``; the passages of a document begin at ``starts``."""
        w = self.weights
        sizes = np.diff(np.concatenate((starts, [len(x)])))
        h = np.tanh(x @ w["encode"] + w["bias"])
        t, g = np.tanh(h @ w["tanh"]), sigmoid(h @ w["gate"])
        logit = (t * g) @ w["attend"]
        raised = np.exp(logit - np.repeat(np.maximum.reduceat(logit, starts), sizes))
        weight = raised / np.repeat(np.add.reduceat(raised, starts), sizes)
        z = np.add.reduceat(weight[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "score": sigmoid(z @ w["out"] + w["last"]), "sizes": sizes}

    def scores(self, vectors: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Scores of the documents that own the passages, in order."""
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        if self.constant is not None:
            return np.full(len(starts), self.constant)
        return self.forward((vectors - self.mean) / self.scale, starts)["score"]

    def gradients(self, x: np.ndarray, starts: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, f = self.weights, self.forward(x, starts)
        wrong = (f["score"] - label) / len(label)
        out = {"out": f["z"].T @ wrong, "last": wrong.sum(keepdims=True)}
        dz = np.repeat(wrong[:, None] * w["out"], f["sizes"], axis=0)
        d_weight = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["weight"] * d_weight, starts), f["sizes"])
        d_logit = f["weight"] * (d_weight - mean)
        out["attend"] = (f["t"] * f["g"]).T @ d_logit
        d_tg = d_logit[:, None] * w["attend"]
        d_t = d_tg * f["g"] * (1 - f["t"] ** 2)
        d_g = d_tg * f["t"] * f["g"] * (1 - f["g"])
        out["tanh"], out["gate"] = f["h"].T @ d_t, f["h"].T @ d_g
        d_h = f["weight"][:, None] * dz + d_t @ w["tanh"].T + d_g @ w["gate"].T
        d_a = d_h * (1 - f["h"] ** 2)
        out["encode"], out["bias"] = x.T @ d_a, d_a.sum(axis=0)
        return out


def fit(vectors: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model for documents given as their passages' vectors; the same for the same input."""
    share = float(labels.mean()) if len(labels) else 0.5
    nothing = np.zeros(WIDTH, np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(nothing, nothing, {}, share)
    random = np.random.default_rng(SEED)
    every = np.concatenate(vectors)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    shapes = {"encode": (WIDTH, HIDDEN), "tanh": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "attend": (GATE,), "out": (HIDDEN,)}
    weights = {k: random.standard_normal(s) / np.sqrt(s[0]) for k, s in shapes.items()}
    weights |= {"bias": np.zeros(HIDDEN), "last": np.array([np.log(share / (1 - share))])}
    model = Model(mean, scale, weights)
    scaled = [(v - mean) / scale for v in vectors]
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(scaled))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            sizes = [len(scaled[i]) for i in some]
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            step += 1
            for k, grad in model.gradients(np.concatenate([scaled[i] for i in some]), starts, labels[some]).items():
                grad = grad + DECAY * weights[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad**2 - second[k])
                weights[k] -= RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES
) -> Model:
    """The model learned from ``labels (doc_id, label)`` that aren't held out."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).cast("double").alias("label"))
    )
    # At most train_docs rows of two numbers, so they may be broadcast.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")
    # Of rows that repeat an id one is taken.
    texts = materialize(texts.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("_one")).select("doc_id", "_one.*"), "labelled")
    chosen = _within(texts, train_passages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                own.tobytes()
                for vectors, owner in blocks(batch.column(1).to_pylist())
                for own in np.split(vectors, np.flatnonzero(np.diff(owner)) + 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "label", "vectors"]
            )

    # Bounded by the numbers of documents and of passages.
    taken = texts.where(F.col("doc_id").isin(chosen)).select("doc_id", "text", "label")
    rows = taken.mapInArrow(run, "doc_id bigint, label double, vectors binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    vectors = [np.frombuffer(r["vectors"], np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(vectors, np.array([r["label"] for r in rows]))


def _within(texts: DataFrame, passages: int) -> list[int]:
    """The ids of the first documents, in the order of a hash, that have so many passages together."""
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    sizes = texts.select("doc_id", F.xxhash64("doc_id").alias("hash"), words.alias("words")).collect()  # bounded as the sample
    chosen, total = [], 0
    for row in sorted(sizes, key=lambda r: (r["hash"], r["doc_id"])):
        total += max(1, -(-row["words"] // PASSAGE))
        if chosen and total > passages:
            break
        chosen.append(row["doc_id"])
    return chosen


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``docs (doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.scores(*b) for b in blocks(batch.column(1).to_pylist())]
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.astype(np.float64))], names=["doc_id", "score"]
            )

    columns = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return columns.mapInArrow(run, "doc_id bigint, score double")
