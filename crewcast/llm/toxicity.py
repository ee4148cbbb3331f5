"""Toxicity with a subsequence string kernel, Nystroem landmarks and a linear support vector machine.

Two words are compared by the three-letter subsequences they share, weighted by 0.6 for every letter skipped. An insult
with inserted letters keeps most of them. The kernel of two sentences is the sum over the pairs of their distinct words of
the cube of the normalised word kernel; a cube keeps unrelated words near zero. Marks between letters are removed, and
letters that stand apart are joined ("i d i o t"). A word whose subsequences shared with any landmark have a norm below
``least`` counts as unrelated, kernel 0.

Landmarks are words of the training sentences, or beginnings of words, that are more frequent in toxic documents: an
insult with many endings is one landmark. The kernel against them, whitened by its value among them, gives a
sentence's features; a squared-hinge machine is trained on sentences, where of each toxic document only the sentence
that scores highest counts as toxic, over a few rounds. A document's score is a logistic function of its three highest
sentences. In features the machine is linear, so a word has one value, and tasks look values up for the distinct
tokens of a batch.
"""

from __future__ import annotations

import ctypes
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from crewcast.llm.samples import labelled

SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]{1,2}){2,}[^\W\d_](?!\w)")
BETWEEN = re.compile(r"[ .\-_*]+")
NO_LETTER = re.compile(r"[\W\d_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")
#: A longer word is read in overlapping parts of this size.
LONGEST = 24
#: Tokens whose values a worker keeps in each of two generations; the older one goes when the younger is full.
MOST_TOKENS = 250_000


@dataclass(frozen=True)
class Settings:
    """Training takes at most this many documents of each class and characters of each document."""

    toxic_docs: int = 500
    clean_docs: int = 1_500
    sample_chars: int = 20_000
    landmarks: int = 160
    decay: float = 0.6
    span: int = 5
    power: int = 3
    #: Words that share less with the landmarks have kernel 0; a word and a landmark that share it all have 1.
    least: float = 0.3
    #: A landmark occurs in this many times as many toxic documents as its share of all, counted with a prior of one document.
    lift: float = 2.0
    #: Beginnings of words, from this many letters, are landmarks too.
    stem: int = 4
    rounds: int = 3
    ridge: float = 1.0
    #: Training sentences whose kernel with every landmark is below this are one row with their number as weight.
    faint: float = 0.05
    #: A document is judged by this many of its highest sentences.
    top: int = 3
    threshold: float = 0.3


def cleaned(token: str) -> list[str]:
    """Words of a token in lower case, without marks; one or two letters are no word."""
    word = token if token.isalpha() else NO_LETTER.sub("", token)
    if len(word) > LONGEST:
        return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]
    return [word] if len(word) > 2 else []


def tokens(text: str | None) -> list[set[str]]:
    """Distinct tokens of each sentence in lower case."""
    low = SPACED.sub(lambda m: BETWEEN.sub("", m.group()), (text or "").lower())
    return [set(s.split()) for s in SENTENCE_END.split(low)]


def sentences(text: str | None) -> list[list[str]]:
    """Distinct words of each sentence that has some, in order."""
    found = [sorted({w for token in s for w in cleaned(token)}) for s in tokens(text)]
    return [s for s in found if s]


def subsequences(words: list[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word number, code, weight) of the weighted three-letter subsequences, each word's weights of norm one."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, group in by_length.items():
        steps = [(i, i + j, i + k) for k in range(2, settings.span + 1) for j in range(1, k) for i in range(length - k)]
        if not steps:
            continue
        first, second, third = np.array(steps).T
        decay = settings.decay ** (third - first - 2).astype(float)
        for begin in range(0, len(group), 2_000):
            numbers = np.array(group[begin : begin + 2_000])
            letters = np.frombuffer("".join([words[i] for i in numbers]).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.int64)
            codes = (letters[:, first] << 42) | (letters[:, second] << 21) | letters[:, third]
            order = np.argsort(codes, axis=1)
            codes = np.take_along_axis(codes, order, 1)
            weights = decay[order]
            # Equal subsequences of a word add up; each is reported once, at its first place.
            new = np.ones(codes.shape, bool)
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            places = np.flatnonzero(new)
            sums = np.add.reduceat(weights.ravel(), places)
            line = places // codes.shape[1]
            norm = np.sqrt(np.bincount(line, sums * sums, minlength=len(numbers)))
            yield numbers[line], codes.ravel()[places], sums / norm[line]


@dataclass
class Landmarks:
    """Weighted subsequences of the landmark words, for kernels against them."""

    words: list[str]
    settings: Settings
    #: Distinct codes in order; the landmarks that hold code i are owner[starts[i] : starts[i + 1]].
    codes: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    owner: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)

    def __post_init__(self):
        parts = list(subsequences(self.words, self.settings))
        number, code, weight = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(code, kind="stable")
        self.codes, first = np.unique(code[order], return_index=True)
        self.starts, self.owner, self.weight = np.r_[first, len(code)], number[order], weight[order]

    def kernel(self, words: list[str]) -> np.ndarray:
        """Power of the normalised kernel, one line per word."""
        size = len(self.words)
        out = np.zeros((len(words), size))
        for number, code, weight in subsequences(words, self.settings):
            place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[place] == code
            number, place, weight = number[hit], place[hit], weight[hit]
            norm = np.bincount(number, weight * weight, minlength=len(words))
            hit = norm[number] >= self.settings.least**2
            number, place, weight = number[hit], place[hit], weight[hit]
            if not len(number):
                continue
            # Each shared subsequence counts once for every landmark that holds it.
            often = self.starts[place + 1] - self.starts[place]
            entry = np.arange(often.sum()) + np.repeat(self.starts[place] - np.cumsum(often) + often, often)
            near, line = np.unique(number, return_inverse=True)
            cell = np.repeat(line * size, often) + self.owner[entry]
            sums = np.bincount(cell, np.repeat(weight, often) * self.weight[entry], minlength=len(near) * size)
            out[near] += sums.reshape(-1, size)  # a word's subsequences stand together, so each word comes once
        return out**self.settings.power


@dataclass
class Model:
    """Document score: logistic of the highest sentences; a sentence is bias + the sum of its word values."""

    landmarks: Landmarks | None
    word_weights: np.ndarray
    bias: float
    #: Weights of the highest sentences in order, then a constant.
    final: np.ndarray
    settings: Settings
    _young: dict[str, float] = field(default_factory=dict, repr=False)
    _old: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_young": {}, "_old": {}}

    def _learn(self, batch: set[str]) -> None:
        """Values of a batch's tokens; a token without words has none (nan)."""
        if len(self._young) > MOST_TOKENS:
            self._young, self._old = {}, self._young
        fresh = batch.difference(self._young)
        known = fresh.intersection(self._old)
        self._young.update((t, self._old[t]) for t in known)
        parts = {t: cleaned(t) for t in fresh - known}
        words = sorted({w for split in parts.values() for w in split})
        value: dict[str, float] = {}
        for begin in range(0, len(words), WORDS):
            part = words[begin : begin + WORDS]
            value.update(zip(part, (self.landmarks.kernel(part) @ self.word_weights).tolist()))
        self._young.update((t, sum(value[w] for w in split) if split else np.nan) for t, split in parts.items())

    def highest(self, texts: Iterable[str | None]) -> np.ndarray:
        """The highest sentence values of each text, highest first; where sentences lack, the bias."""
        split = [tokens(t) for t in texts]
        top = self.settings.top
        out = np.full((len(split), top), self.bias)
        if self.landmarks is None:
            return out
        self._learn({t for text in split for s in text for t in s})
        value = self._young.__getitem__
        for line, text in zip(out, split):
            sums = [sum(held) for held in ([v for v in map(value, s) if v == v] for s in text) if held]
            best = sorted(sums, reverse=True)[:top]
            line[: len(best)] += best
        return out

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.highest(texts) @ self.final[:-1] + self.final[-1], -50, 50)))


#: Sentences that a step of the fit takes at once.
PIECE = 2_048
#: Words whose kernels are computed at once.
WORDS = 2_000


def give_back() -> None:
    """Return freed memory to the system; the C library would keep it for as long as the driver lives."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _machine(features: np.ndarray, taken: np.ndarray, signs: np.ndarray, cost: np.ndarray, ridge: float) -> np.ndarray:
    """Squared-hinge machine with a constant, by Newton steps on the taken rows inside the margin, summed some rows at a time."""
    size = features.shape[1] + 1
    weights = np.zeros(size)
    for _ in range(20):
        square, right = ridge * np.eye(size), np.zeros(size)
        for begin in range(0, len(taken), PIECE):
            part = taken[begin : begin + PIECE]
            rows = np.ones((len(part), size))
            rows[:, :-1] = features[part]
            inside = signs[part] * (rows @ weights) < 1
            rows, weight = rows[inside], cost[part][inside]
            square += (rows * weight[:, None]).T @ rows
            right += rows.T @ (weight * signs[part][inside])
        after = np.linalg.solve(square, right)
        if np.allclose(after, weights, atol=1e-7):
            break
        weights = after
    return weights


def _logistic(values: np.ndarray, labels: np.ndarray, number: np.ndarray) -> np.ndarray:
    rows = np.c_[values, np.ones(len(values))]
    found, ridge = np.zeros(rows.shape[1]), np.eye(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ found, -50, 50)))
        slope = (rows * (number * p * (1 - p))[:, None]).T @ rows + ridge
        step = np.linalg.solve(slope, rows.T @ (number * (labels - p)) - found)
        found = found + step
        if np.abs(step).max() < 1e-9:
            break
    return found


def stretched(words: list[str], known: set[str]) -> list[str]:
    """The words with one letter put inside each known one, at a place and of a kind that its letters decide."""
    out = []
    for word in words:
        if word in known and len(word) < LONGEST:
            at = 1 + sum(map(ord, word)) % (len(word) - 1)
            word = word[:at] + "xzqjkw"[ord(word[at]) % 6] + word[at:]
        out.append(word)
    return out


def _near_words(words: list[str], marks: Landmarks) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """Kernel lines of the words that are not all but zero: line i has values[starts[i] : starts[i + 1]] in those columns, the rest is zero."""
    place, columns, values, starts = {}, [], [], [0]
    for begin in range(0, len(words), WORDS):
        kernel = marks.kernel(words[begin : begin + WORDS]).astype(np.float32)
        near = np.flatnonzero(kernel.max(1) > 0.01)
        known = len(place)
        place.update({words[begin + i]: known + n for n, i in enumerate(near)})
        line, column = np.nonzero(kernel[near])
        columns.append(column.astype(np.uint16))
        values.append(kernel[near[line], column])
        starts += (starts[-1] + np.cumsum(np.bincount(line, minlength=len(near)))).tolist()
    return place, np.array(starts), np.concatenate(columns), np.concatenate(values)


def chosen_landmarks(split: list[list[list[str]]], labels: list[int], settings: Settings) -> list[str]:
    """Words and beginnings of words with the largest gain in toxic over clean documents; none begins another."""
    def beginnings(text: list[list[str]]) -> set[str]:
        return {w[:n] for s in text for w in s for n in range(min(settings.stem, len(w)), len(w) + 1)}

    seen: Counter = Counter()
    for text, label in zip(split, labels):
        if label:
            seen.update(beginnings(text))
    seen = Counter({w: n for w, n in seen.items() if n >= 2})
    others: Counter = Counter()
    for text, label in zip(split, labels):
        if not label:
            others.update(beginnings(text).intersection(seen))
    toxic, every = max(1, sum(labels)), max(1, len(labels))
    clean = max(1, every - toxic)
    gain = {}
    for word, n in seen.items():
        other = others[word]
        if n >= settings.lift * (n + other + 1) * toxic / every:
            gain[word] = (n / toxic - other / clean) / np.sqrt((n + other) / every)
    chosen: dict[str, None] = {}
    begun: set[str] = set()
    for word in sorted(gain, key=lambda w: (-gain[w], -len(w), w)):
        if word not in begun and not any(word[:n] in chosen for n in range(1, len(word))):
            chosen[word] = None
            begun.update(word[:n] for n in range(1, len(word) + 1))
            if len(chosen) == settings.landmarks:
                break
    return list(chosen)


def fit(texts: list[str], labels: list[int], settings: Settings = Settings(), toxic_share: float | None = None) -> Model:
    """Model of a bounded sample. With one class only, every score is that class's share, smoothed.

    Toxic documents are also learned with a letter inserted into each landmark word. ``toxic_share`` is that of all
    labelled documents, if the sample has another; scores are chances at that share.
    """
    y = np.array(labels, float)
    share = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    constant = lambda: Model(None, np.zeros(0), 0.0, np.r_[np.zeros(settings.top), share], settings)
    one: dict[str, str] = {}  # equal words are one object
    split = [[[one.setdefault(w, w) for w in s] for s in sentences(t)] for t in texts]
    words = chosen_landmarks(split, labels, settings)
    give_back()
    if not words or y.all():
        return constant()
    marks = Landmarks(words, settings)
    known = set(words)
    split += [[stretched(s, known) for s in text] for text, label in zip(split, labels) if label]
    positive_text = np.r_[y, np.ones(len(split) - len(y))] == 1
    place, starts, columns, values = _near_words(sorted({w for text in split for s in text for w in s}), marks)
    # Lines that no sentence fills take no memory.
    sums = np.empty((sum(map(len, split)) + 1, len(words)), np.float32)
    owner, faint, together = [], 0, np.zeros(len(words))
    for d, text in enumerate(split):
        for sentence in text:
            near = np.zeros(len(words), np.float32)
            for line in [place[w] for w in sentence if w in place]:
                part = slice(starts[line], starts[line + 1])
                near[columns[part]] += values[part]
            if positive_text[d] or near.max() >= settings.faint:
                sums[len(owner)] = near
                owner.append(d)
            else:
                faint += 1
                together += near
    sums[len(owner)] = together / max(1, faint)
    owner, sums = np.array(owner), sums[: len(owner) + 1]
    count = len(split)
    del place, starts, columns, values, split, one
    give_back()
    values, vectors = np.linalg.eigh(marks.kernel(words))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
    positive, number = np.r_[positive_text[owner], False], np.r_[np.ones(len(owner)), max(1.0, faint)]
    signs, value = np.where(positive, 1.0, -1.0), sums.max(1)
    for begin in range(0, len(sums), PIECE):
        sums[begin : begin + PIECE] = sums[begin : begin + PIECE] @ whiten
    for _ in range(settings.rounds + 1):
        best = np.full(count, -np.inf)
        np.maximum.at(best, owner, value[:-1])
        chosen = ~positive | np.r_[value[:-1] >= best[owner], True]
        balance = min(20.0, number[~positive].sum() / max(1, (positive & chosen).sum()))
        weights = _machine(sums, np.flatnonzero(chosen), signs, np.where(positive, balance, 1.0) * number, settings.ridge)
        value = sums @ weights[:-1].astype(np.float32) + weights[-1]
    del sums
    model = Model(marks, whiten @ weights[:-1], float(weights[-1]), np.zeros(settings.top + 1), settings)
    share = y.mean() if toxic_share is None else toxic_share
    highest = np.concatenate([model.highest(texts[i : i + 100]) for i in range(0, len(texts), 100)])
    model.final = _logistic(highest, y, np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())))
    model._young, model._old = {}, {}
    give_back()
    return model


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of labelled documents; labels other than 0 and 1 are left out.

    Without any labelled text nothing is known to be toxic: every score is all but 0, and nothing is rejected.
    """
    marked = labels.filter(labels[label_col].isin(0, 1))
    taken, found = Counter(), []
    for label, text in labelled(docs, marked, max(settings.toxic_docs, settings.clean_docs), settings.sample_chars, id_col, text_col, label_col):
        taken[label] += 1
        if taken[label] <= (settings.toxic_docs if label else settings.clean_docs):
            found.append((label, text))
    if not found:
        return Model(None, np.zeros(0), 0.0, np.r_[np.zeros(settings.top), -50.0], settings)
    share = marked.agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    return fit([t for _, t in found], [y for y, _ in found], settings, share)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """One row per row of ``docs``: id, ``more`` columns, score, predicted (score >= threshold). Whole texts are read.

    A null or empty text, or one without words, has the score of a document without toxic words.
    """
    rows = docs.select(docs[id_col].alias("id"), *[c.alias(name) for name, c in more.items()], scored(docs, model, text_col).alias("score"))
    return rows.select(F.col("id").alias(id_col), *more, "score", (F.col("score") >= model.settings.threshold).cast("int").alias("predicted"))


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks only, whatever the data

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            values = texts.tolist()
            yield pd.Series(np.concatenate([shared.value.score(values[i : i + 250]) for i in range(0, len(values), 250)] or [np.zeros(0)]))

    return F.pandas_udf(run, "double")(docs[text_col])


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, columns unchanged.

    Ids are not looked at: rows with a null id and repeated rows are judged by their texts alone. A null or empty text stays.
    """
    return docs.filter(scored(docs, model, text_col) < model.settings.threshold)
