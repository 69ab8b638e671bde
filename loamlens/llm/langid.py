"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loamlens.llm.common import held_out, text_digest

#: hashed character n-grams of 1 to ORDER letters
BUCKETS, ORDER = 1 << 14, 3
#: bounds of the sample: languages (those with the most texts), documents in all, code points of a document
MAX_LANGUAGES, SAMPLE_DOCS, SAMPLE_CHARS = 200, 1600, 20_000
UNDETERMINED = "und"

# fixed values: language families by ISO 639-1 code; a language not listed is in the family "other"
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "turkic": "tr az kk uz",
    "indic": "hi bn mr ne pa gu ur",
    "semitic": "ar he am mt",
    "sinitic": "zh yue",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(language: str) -> str:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], "other")


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool,
                       sys.maxunicode + 1)


_letters: list[np.ndarray] = []


def grams(text: str | None) -> np.ndarray:
    """Buckets of all n-grams of the lower-cased letters; anything else is one space between words.

    Empty if there is no letter.
    """
    if not _letters:
        _letters.append(_letter_table())
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters[0][code]
    if not letter.any():
        return np.empty(0, np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters stands for all
    code = np.concatenate([[32], np.where(letter, code, 32)[keep], [32]]).astype(np.uint32)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    hashed, out = np.zeros(len(code), np.uint32), []
    for n in range(1, ORDER + 1):
        hashed = (hashed[:len(code) - n + 1] + code[n - 1:]) * np.uint32(0x9E3779B1) + np.uint32(n)
        out.append((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> shift)
    return np.concatenate(out)


def _features(texts: list[str]) -> np.ndarray:
    rows = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(rows, texts):
        found = grams(text)
        row += np.bincount(found, minlength=BUCKETS) / max(1, len(found))
    return rows


def svm(x: np.ndarray, positive: np.ndarray, steps: int = 150, penalty: float = 1e-3):
    """A linear SVM with squared hinge loss, both classes weighted alike, by accelerated descent."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    w, ahead, b, ahead_b = (np.zeros(x.shape[1], np.float32),) * 2 + (0.0, 0.0)
    rate = 0.5 / (2 * float((weight * ((x * x).sum(axis=1) + 1)).sum()) + penalty)
    for step in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (x @ ahead + ahead_b)) * weight * y
        new = ahead + 2 * rate * (x.T @ slack.astype(np.float32)) - rate * penalty * ahead
        new_b = ahead_b + 2 * rate * float(slack.sum())
        push = (step - 1) / (step + 2)
        ahead, ahead_b = new + push * (new - w), new_b + push * (new_b - b)
        w, b = new, new_b
    return w, b


@dataclass(frozen=True)
class Model:
    """One column of ``weights`` per decision: first a family against the rest, then pairs."""

    families: tuple[tuple[str, ...], ...]  # the languages of each family
    pairs: tuple[tuple[int, int, int], ...]  # family, and two of its languages
    weights: np.ndarray
    biases: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text)
        if not len(found) or not self.families:
            return UNDETERMINED, 0.0
        counts = np.bincount(found, minlength=BUCKETS).astype(np.float32)
        margins = counts @ self.weights * (self.scale / len(found)) + self.biases
        n = len(self.families) if len(self.families) > 1 else 0
        at = int(np.argmax(margins[:n])) if n else 0
        sure = _sigmoid(margins[at]) if n else 1.0
        languages = self.families[at]
        votes, least = np.zeros(len(languages)), np.full(len(languages), np.inf)
        for (family, a, b), margin in zip(self.pairs, margins[n:]):
            if family == at:
                votes[a if margin >= 0 else b] += 1
                least[a], least[b] = min(least[a], margin), min(least[b], -margin)
        winner = max(range(len(languages)), key=lambda i: (votes[i], least[i], -i))
        if len(languages) > 1:
            sure *= _sigmoid(least[winner])
        return languages[winner], float(sure)

    scale = 20.0


def _sigmoid(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(3 * margin, -50, 50))))


def fit(texts: list[str], languages: list[str]) -> Model:
    """Families in alphabetical order of their names, languages within them too."""
    grouped: dict[str, list[str]] = {}
    for language in sorted(set(languages)):
        grouped.setdefault(family_of(language), []).append(language)
    families = tuple(tuple(grouped[f]) for f in sorted(grouped))
    x, label = _features(texts) * np.float32(Model.scale), np.array(languages)
    fitted, pairs = [], []
    if len(families) > 1:
        fitted += [svm(x, np.isin(label, members)) for members in families]
    for at, members in enumerate(families):
        for a, b in combinations(range(len(members)), 2):
            rows = np.isin(label, (members[a], members[b]))
            fitted.append(svm(x[rows], label[rows] == members[a]))
            pairs.append((at, a, b))
    weights = np.stack([w for w, _ in fitted], 1) if fitted else np.zeros((BUCKETS, 0))
    return Model(families, tuple(pairs), np.ascontiguousarray(weights, np.float32),
                 np.array([b for _, b in fitted]))


def train(docs: DataFrame, sample: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """Learn from ``lang`` and ``text`` of at most ``sample`` documents that are not held out.

    A text counts once per language, however many rows hold it. Languages take turns, each with the smallest
    digests of its texts first, so they have equal numbers as far as their texts go. Texts of more than
    ``chars`` code points and those without an id, text or ``lang`` are not learned from. As each two languages of a
    family need a classifier, of more than ``MAX_LANGUAGES`` those with the most texts are learned.
    """
    known = docs.select("doc_id", "lang", "text").where(
        "doc_id is not null and lang is not null and text is not null").where(~held_out())
    known = known.where(F.char_length("text") <= chars).select("lang", "text", *text_digest())
    key = ["lang", "h1", "h2"]
    texts = known.select(*key).distinct()
    most = texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    # digests are spread evenly: these hold the first ``sample`` ones, and are as many for every size of a language
    first = F.shiftrightunsigned("h1", 24) < F.lit(float(1 << 40)) * F.lit(2.0 * sample + 200) / F.col("count")
    placed = (F.col("h1") < 0, "h1", "h2")  # in the order of unsigned numbers
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*placed))
    chosen = texts.join(F.broadcast(most), "lang").where(first).withColumn("turn", turn).where(F.col("turn") <= sample)
    chosen = chosen.orderBy("turn", F.xxhash64("lang"), "lang").limit(sample).select(*key)
    rows = known.join(F.broadcast(chosen), key).groupBy(*key).agg(F.min("text").alias("text"))
    rows = rows.orderBy(*key).select("text", "lang").toArrow()
    return fit(rows.column("text").to_pylist(), rows.column("lang").to_pylist())


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every row of ``docs``.

    ``und`` with score 0 if the text is null, has no letter, or nothing was learned. Rows are neither
    shuffled nor dropped, repeated ones stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            out = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")


def languages(docs: DataFrame, **sample) -> DataFrame:
    """Train on the documents that aren't held out and predict all of ``docs``."""
    result = identified(docs, train(docs, **sample))
    return result.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
