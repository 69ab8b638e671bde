"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loamlens.llm.common import held_out, text_digest

#: hashed vectors and their length, words of a window
BUCKETS, DIMENSIONS, WINDOW = 1 << 16, 8, 1
#: bounds of the sample a model learns from: documents of either class, code points of a document
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 800, 1600, 20_000
#: texts that must share a subword for its vector to be learned; the bucket of all others
MIN_DOCS, RARE = 5, 0
#: words a task remembers from one group of texts to the next, words hashed and code points scored together
REMEMBERED, WORDS, TOGETHER = 300_000, 1 << 14, 1 << 21


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its character 3- to 5-grams, and the place of the word of each.

    Misspellings share most of them. All words are hashed together, gram by gram.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"),
                         np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends, owner = np.cumsum(size), np.repeat(np.arange(len(words)), size)
    left = np.repeat(ends, size) - np.arange(len(code))  # characters to the end of the word
    hashed, buckets, owners = code, [], []
    for n in range(2, 6):
        hashed = hashed[:-1] * _FACTOR + code[n - 1:]
        if n > 2:
            inside = left[:len(hashed)] >= n
            buckets.append(_bucket(hashed[inside] + np.uint64(n)))
            owners.append(owner[:len(hashed)][inside])
    powers = np.cumprod(np.full(size.max() + 1, _FACTOR))
    buckets.append(_bucket(_grouped_sum(code * powers[left], ends - size)))
    owners.append(np.arange(len(words)))
    return np.concatenate(buckets), np.concatenate(owners)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashed: np.ndarray) -> np.ndarray:
    mixed = (hashed ^ (hashed >> np.uint64(29))) * _FACTOR
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _bare(word: str) -> str:
    return word.strip(".,;:!?\"'()[]") or word


@dataclass(frozen=True)
class Model:
    """What scoring needs: the difference of the two softmax logits per bucket, and the bias."""

    bucket: np.ndarray
    bias: float

    def words(self, words: list[str]) -> np.ndarray:
        """The mean over the subwords of each word."""
        means = []
        for at in range(0, len(words), WORDS):
            part = [_bare(w) for w in words[at:at + WORDS]]
            gram, owner = subwords(part)
            total = np.bincount(owner, self.bucket[gram], len(part))
            means.append(total / np.bincount(owner, minlength=len(part)))
        return np.concatenate(means) if means else np.zeros(0)


def _grouped_sum(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0)


def _common(vocabulary, word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of each word that at least ``MIN_DOCS`` texts have; the others can't be learned.

    They share one bucket, whose vector stays as it is at the start. Buckets come by word, with
    their number per word.
    """
    gram, owner = subwords(list(vocabulary))
    order = np.argsort(owner, kind="stable")
    gram, owner = gram[order], owner[order]
    pairs = np.unique(doc.astype(np.int64) * len(vocabulary) + word)
    in_docs = np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
    once = np.unique(owner * BUCKETS + gram)
    seen = np.bincount(once % BUCKETS, in_docs[once // BUCKETS], BUCKETS)
    return np.where(seen[gram] >= MIN_DOCS, gram, RARE), np.bincount(owner)


def fit(texts: list[str], labels: list[int], steps: int = 100, rate: float = 0.05,
        decay: float = 5e-3, seed: int = 42) -> Model:
    """Embeddings and softmax together by Adam, over whole texts.

    A word's vector is the mean of its subwords', a window's the mean of its words', each window has a
    softmax logit, and a text's logit is the log-sum-exp of its windows': one bad window is enough,
    however long the text. Texts without a word are left out; with one class or none the model is
    constant.
    """
    vocabulary: dict[str, int] = {}
    occurrences, sizes, per_doc, wanted = [], [], [], []
    for text, label in zip(texts, labels):
        ids = [vocabulary.setdefault(_bare(w), len(vocabulary)) for w in words_of(text)]
        if ids:
            occurrences += ids
            windows = [min(WINDOW, len(ids) - i) for i in range(0, len(ids), WINDOW)]
            sizes += windows
            per_doc.append(len(windows))
            wanted.append(label)
    y = np.array(wanted, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if not len(y) else 20.0 * y[0] - 10.0)
    word, size = np.array(occurrences, np.int32), np.array(sizes)
    window_start = np.cumsum(size) - size
    window = np.repeat(np.arange(len(size)), size)
    doc_size = np.array(per_doc)
    doc_start = np.cumsum(doc_size) - doc_size
    gram, gram_size = _common(vocabulary, word,
                              np.repeat(np.arange(len(y)), np.add.reduceat(size, doc_start)))
    gram_start = np.cumsum(gram_size) - gram_size

    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.5, (BUCKETS, DIMENSIONS))
    u = rng.normal(0, 0.5, (DIMENSIONS, 2))
    b = np.array([0.0, -float(np.log(doc_size.mean()) + 1)])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, u, b)]
    for step in range(1, steps + 1):
        difference = u[:, 1] - u[:, 0]
        per_word = _grouped_sum((e @ difference)[gram], gram_start) / gram_size
        logit = _grouped_sum(per_word[word], window_start) / size + b[1] - b[0]
        top = np.maximum.reduceat(logit, doc_start)
        raised = np.exp(logit - np.repeat(top, doc_size))
        total = _grouped_sum(raised, doc_start)
        z = top + np.log(total)
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        d_logit = np.repeat(error / total, doc_size) * raised
        d_word = np.bincount(word, (d_logit / size)[window], len(vocabulary))
        d_bucket = np.bincount(gram, np.repeat(d_word / gram_size, gram_size), BUCKETS)
        d_difference = e.T @ d_bucket
        slopes = (np.outer(d_bucket, difference) + decay / len(y) * e,
                  np.stack([-d_difference, d_difference], 1) + decay * u,
                  np.array([-1.0, 1.0]) * d_logit.sum())
        for p, (mean, square), slope in zip((e, u, b), state, slopes):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            p -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
    return Model((e @ (u[:, 1] - u[:, 0])).astype(np.float32), float(b[1] - b[0]))


class Scorer:
    """Scores texts, remembering words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, text: str | None) -> float:
        return float(self.many([text])[0])

    def many(self, texts: list[str | None]) -> np.ndarray:
        """Texts are taken together, ``TOGETHER`` code points or one text at a time."""
        scores, part, held = [], [], 0
        for text in texts:
            part.append(text)
            held += len(text or "")
            if held >= TOGETHER:
                scores.append(self._scores(part))
                part, held = [], 0
        return np.concatenate([*scores, self._scores(part)])

    def _scores(self, texts: list[str | None]) -> np.ndarray:
        words = [words_of(t) for t in texts]
        known = self.known
        new = list({w for each in words for w in each if w not in known})
        known.update(zip(new, self.model.words(new).tolist()))
        out = np.zeros(len(texts))
        for i, each in enumerate(words):
            if each:
                values = np.fromiter(map(known.__getitem__, each), float, len(each))
                starts = np.arange(0, len(each), WINDOW)
                size = np.diff(np.append(starts, len(each)))
                logit = np.add.reduceat(values, starts) / size + self.model.bias
                top = logit.max()
                z = top + np.log(np.exp(logit - top).sum())
                out[i] = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        if len(known) > REMEMBERED:
            known.clear()
        return out


def train(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN,
          chars: int = SAMPLE_CHARS) -> Model:
    """Learn from at most ``toxic`` and ``clean`` labelled texts that are not held out.

    A text counts once, however many rows and ids hold it, and is toxic if any label says so. The sample has
    the smallest digests of texts; those of more than ``chars`` code points are not learned from. Null
    labels, ids and texts are left out; of several texts of an id each one counts.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.where("doc_id is not null and text is not null").where(~held_out())
    texts = texts.where(F.char_length("text") <= chars).select("doc_id", "text", *text_digest())
    key = ["h1", "h2"]
    told = texts.select("doc_id", *key).distinct().join(known, "doc_id").groupBy(*key).agg(
        F.max("toxic").alias("toxic"))
    # at most toxic + clean rows of three numbers
    chosen = told.where("toxic = 1").orderBy(*key).limit(toxic).unionByName(
        told.where("toxic = 0").orderBy(*key).limit(clean))
    rows = texts.join(F.broadcast(chosen), key).groupBy(*key).agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = rows.orderBy(*key).select("text", "toxic").toArrow()
    return fit(rows.column("text").to_pylist(), rows.column("toxic").to_pylist())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` of every row of ``docs``.

    Null and empty texts score 0. Rows are neither shuffled nor dropped, repeated ones stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = Scorer(shared.value)
        for batch in batches:
            values = score.many(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """Train on the labelled part and score all of ``docs``; ``held_out`` marks unseen labels."""
    result = scored(docs, train(docs, labels, **sample))
    return result.select("doc_id", held_out().alias("held_out"), "score", "predicted")
