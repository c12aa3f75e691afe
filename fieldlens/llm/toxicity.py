"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

A token that may be disguised (digits or signs among letters, a letter three times or more in a row, single letters
spaced out) becomes a lattice: each sign may stand for itself or for letters it resembles, each repetition and each
separator may be noise. Viterbi decoding under a character trigram model and a fixed channel cost finds the likeliest
word. Tokens that cannot be disguised have one path only and are kept. A span longer than two words may be a whole
sentence: in it, a word may end at any separator or, where there is none, after any character.

The trigrams are those of the words of all documents, each word weighted by the number of binary digits of its count.
Words and trigrams are counted by executors; what reaches the driver grows with the corpus up to the alphabet's
bound, as letters without case, which signs do not stand for, count as one letter.

The restored text is scored by logistic regression over its telling terms: words and their beginnings of 4 to 6
characters. Learning uses a bounded sample of labelled rows (``TRAIN_ROWS``, chosen by a hash of doc_id), which is
restored once; the terms that ``LEAST`` toxic documents of it hold and that point to label 1 are kept.

Defined results: null and empty texts get the score of a text without any telling term; labels that are null
are not learned; a doc_id that several rows share is learned once for each label, with its least text; without labelled
rows every score is 0; repeated rows each keep a row, and equal texts get equal scores; texts of any length are scored
whole; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, read
from fieldlens.llm._text import blocks
from fieldlens.llm.quality import held_out, training_rows

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
LEAST = 4
HELD = 200_000  # words that a task holds before it passes their counts on
LONGEST = 40  # longer runs of letters are no words; spans over twice that may hold several words

#: What a sign may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "€": "e", "£": "l"}
_SIGNS = "".join(re.escape(c) for c in LOOKS_LIKE)
#: A token in which letters and signs touch, letters that repeat, or spaced letters.
_MIXED = re.compile(rf"(?:[^\W\d_]*[{_SIGNS}*]+[^\W\d_]\w*)+(?:[{_SIGNS}*]+\w+)*(?:[$@]{{1,2}}(?![^\s.,]))?|[^\W\d_]+[$@]{{1,2}}(?![^\s.,])")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_SPACED = re.compile(rf"(?<![\w{_SIGNS}])(?:[^\W\d_{{}}]|[{_SIGNS}])(?:([ .\-_*])(?:[^\W_]|[{_SIGNS}])(?![^\W_])){{2,}}(?!\w)")
_SIGN = re.compile(rf"[{_SIGNS}*]")
_BLANK = re.compile(r"\s")
_WORD = re.compile(r"[^\W_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")
_SEPARATOR = re.compile(r"[\s.\-_]")


def trigrams(words: dict[str, int]) -> Counter:
    """Weights of the trigrams of weighted words, with word bounds."""
    out: Counter = Counter()
    for word, n in words.items():
        padded = "\x02\x02" + "".join(map(folded, word)) + "\x03"
        for i in range(2, len(padded)):
            out[padded[i - 2 : i + 1]] += n
    return out


def folded(c: str) -> str:
    """The letter itself if it has case, digits and marks too; one letter for all others."""
    return "\u3042" if c.isalpha() and c.lower() == c.upper() else c


class CharacterModel:
    """Trigrams of characters with word bounds, interpolated with lower orders."""

    def __init__(self, tri: dict[str, int]):
        self.tri, self.bi, self.uni = Counter(tri), Counter(), Counter()
        self.before2, self.before1 = Counter(), Counter()
        for k, n in self.tri.items():
            self.bi[k[1:]] += n
            self.uni[k[2]] += n
            self.before2[k[:2]] += n
        for k, n in self.bi.items():
            self.before1[k[:1]] += n
        self.total = sum(self.uni.values()) or 1
        self._cost: dict[str, float] = {}

    def cost(self, context: str, c: str) -> float:
        asked = context + c
        got = self._cost.get(asked)
        if got is None:
            key = "".join(map(folded, context + c))
            context, c = key[:2], key[2]
            u = (self.uni[c] + 0.1) / (self.total + 100)
            b = (self.bi[key[1:]] + 3 * u) / (self.before1[context[1:]] + 3)
            t = (self.tri[key] + 3 * b) / (self.before2[context] + 3)
            got = self._cost[asked] = -math.log(t)
        return got


KEEP, STANDS_FOR, DROP_REPEAT, DROP_SIGN, WILD, BREAK = 0.05, 0.4, 0.3, 16.0, 1.0, 1.0


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character of a token, what it may stand for ('' if noise) and the channel's cost."""
    out: list[list[tuple[str, float]]] = []
    for i, c in enumerate(token):
        if c == "*":
            choices = [(x, WILD) for x in "aeiou"] + [("", WILD)]
        elif c == " ":
            choices = [("", KEEP), (" ", BREAK)]
        elif c in LOOKS_LIKE:
            choices = [(x, STANDS_FOR) for x in LOOKS_LIKE[c]] + [("", DROP_SIGN)]
        elif c.isalpha():
            choices = [(c, KEEP)]
            if i and token[i - 1] == c:
                choices.append(("", DROP_REPEAT))
        elif c.isalnum():
            choices = [(c, KEEP)]
        else:
            choices = [("", KEEP)]
        out.append(choices)
    return out


def decode(token: str, model: CharacterModel) -> str:
    """The likeliest word behind a token, by Viterbi over its lattice."""
    best: dict[str, tuple[float, str]] = {"\x02\x02": (0.0, "")}
    settled: list[str] = []
    for i, choices in enumerate(lattice(token.lower()), 1):
        step: dict[str, tuple[float, str]] = {}
        for context, (cost, word) in best.items():
            for c, channel in choices:
                total = cost + channel + (model.cost(context, "\x03" if c == " " else c) if c else 0.0)
                state = "\x02\x02" if c == " " else context[1] + c if c else context
                if state not in step or (total, word + c) < step[state]:
                    step[state] = (total, word + c)
        best = step
        if i % 256 == 0:  # what all paths share is settled, so that long spans take linear time
            settled.append(os.path.commonprefix([word for _, word in best.values()]))
            best = {context: (cost, word[len(settled[-1]) :]) for context, (cost, word) in best.items()}
    return "".join(settled) + min((cost + model.cost(context, "\x03"), word) for context, (cost, word) in best.items())[1]


def unbroken(span: str) -> str:
    """A long span with letters stretched no further than three times and, if it is still long, blanks where words may end."""
    span = _STRETCHED.sub(r"\1\1\1", span)
    if len(span) <= 2 * LONGEST:
        return span
    return _SEPARATOR.sub(" ", span) if _SEPARATOR.search(span) else " ".join(span)


_PLAIN = np.array([chr(c).isalnum() for c in range(128)] + [False])
_SPACING = np.array([chr(c) in " .-_*" for c in range(128)] + [False])


def _may_hold(text: str) -> tuple[bool, bool]:
    """Whether a text has a character three times in a row, and whether it has single characters with equal separators; both are quick to see."""
    c = np.frombuffer(f"\n{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    same = c[1:] == c[:-1]
    tripled = bool((same[1:] & same[:-1]).any())
    if len(c) < 7:
        return tripled, False
    low = np.minimum(c, 128)
    plain, spacing = _PLAIN[low], _SPACING[low]
    return tripled, bool((spacing[2:-4] & (c[2:-4] == c[4:-2]) & ~plain[:-6] & ~plain[6:]).any())


def disguised(text: str) -> list[tuple[int, int]]:
    """Spans of a text that may be disguised words, in order, without overlaps."""
    spans, past = [], 0
    for sign in _SIGN.finditer(text):
        if (at := sign.start()) >= past:  # look once at each run without white space that holds a sign
            a = at
            while a > past and not text[a - 1].isspace():
                a -= 1
            end = _BLANK.search(text, at)
            past = end.start() if end else len(text)
            spans += [m.span() for m in _MIXED.finditer(text, a, past) if any(map(str.isalpha, m.group()))]
    past = 0
    tripled, spaced = _may_hold(text)
    for m in _REPEATED.finditer(text) if tripled else ():
        a, b = m.span()
        if a < past:
            continue
        while a and text[a - 1].isalpha():
            a -= 1
        while b < len(text) and text[b].isalpha():
            b += 1
        spans.append((a, b))
        past = b
    spans += [m.span() for m in (_SPACED.finditer(text) if spaced else ()) if len(m.group()) > 5 or any(map(str.isalpha, m.group()))]
    out, past = [], 0
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= past:
            out.append((a, b))
            past = b
    return out


def restore(text: str, model: CharacterModel, cache: dict[str, str]) -> str:
    """The lower-cased text with its disguised words decoded."""
    out, past = [], 0
    for a, b in disguised(text):
        token = text[a:b]
        if b - a > 2 * LONGEST:
            word = decode(unbroken(token), model)
        elif (word := cache.get(token)) is None:
            if len(cache) > 200_000:
                cache.clear()
            word = cache[token] = decode(token, model)
        out += [text[past:a], word]
        past = b
    return "".join([*out, text[past:]]).lower()


def terms(text: str) -> set[str]:
    """Words of a restored text, and the beginnings of longer ones (marked by *)."""
    words = set(_WORD.findall(text))
    return words | {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) > k}


class Scorer:
    """Weights of telling terms, and the log odds of a text without any."""

    def __init__(self, model: CharacterModel, terms: list[str]):
        self.model, self.terms = model, {t: i for i, t in enumerate(terms)}
        self.words = {t for t in terms if not t.endswith("*")}
        self.starts = {k: {t[:-1] for t in terms if t.endswith("*") and len(t) == k + 1} for k in (4, 5, 6)}
        self.weights, self.start = np.zeros(len(terms)), -50.0
        self.cache: dict[str, str] = {}
        self.of_word: dict[str, tuple[int, ...]] = {}

    def _terms_of(self, word: str) -> tuple[int, ...]:
        if len(self.of_word) > HELD:
            self.of_word.clear()
        held = [self.terms[word]] if word in self.words else []
        held += [self.terms[word[:k] + "*"] for k, starts in self.starts.items() if len(word) > k and word[:k] in starts]
        got = self.of_word[word] = tuple(held)
        return got

    def of_restored(self, text: str) -> list[int]:
        """The telling terms of a restored text."""
        held: set[int] = set()
        known = self.of_word
        for word in set(_WORD.findall(text)):
            got = known.get(word)
            if got is None:
                got = self._terms_of(word)
            if got:
                held.update(got)
        return sorted(held)

    def found(self, text: str) -> list[int]:
        """The telling terms of a text."""
        return self.of_restored(restore(text, self.model, self.cache))

    def fit(self, found: list[list[int]], labels: np.ndarray, steps: int = 300, rate: float = 2.0, ridge: float = 1e-4) -> None:
        """Logistic regression by gradient descent with momentum; weights stay at or above 0."""
        n = len(labels)
        if not n or not labels.any():
            return
        owner = np.repeat(np.arange(n), [len(f) for f in found])
        term = np.array([t for f in found for t in f], np.int64)
        w, speed, self.start, push = np.zeros(len(self.terms)), np.zeros(len(self.terms)), float(np.log(labels.mean() / (1.001 - labels.mean()))), 0.0
        held = np.maximum(np.bincount(term, minlength=len(w)), 1)
        for _ in range(steps):
            margin = self.start + np.bincount(owner, w[term], n)
            error = 1 / (1 + np.exp(-margin)) - labels
            speed = 0.9 * speed - rate * 0.1 * (np.bincount(term, error[owner], len(w)) / np.sqrt(held) / 3 + ridge * w)
            push = 0.9 * push - rate * error.mean()
            w = np.maximum(w + speed, 0)
            self.start += push
        self.weights = w

    def score(self, text: str) -> float:
        margin = self.start + sum(self.weights[t] for t in self.found(text))
        return 1 / (1 + math.exp(-margin))


def character_model(docs: DataFrame) -> CharacterModel:
    """The trigrams of the words of all rows of docs(text)."""

    def plain_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        count: Counter = Counter()
        for batch in blocks(batches, "text"):
            for text in batch.column("text").to_pylist():
                count.update(_WORD.findall((text or "").lower()))
            if len(count) > HELD:
                yield pa.RecordBatch.from_pydict({"word": list(count), "n": list(count.values())}, schema)
                count.clear()
        yield pa.RecordBatch.from_pydict({"word": list(count), "n": list(count.values())}, schema)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = zip(batch.column("word").to_pylist(), batch.column("n").to_pylist())
            count = trigrams({w: n.bit_length() for w, n in words if w.isalpha() and len(w) <= LONGEST})
            yield pa.RecordBatch.from_pydict({"gram": list(count), "n": list(count.values())}, pa.schema([("gram", pa.string()), ("n", pa.int64())]))

    words = docs.select("text").mapInArrow(plain_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = words.mapInArrow(grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by the letters with case
    return CharacterModel(dict(zip(counted.column("gram").to_pylist(), counted.column("n").to_pylist())))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Scorer:
    """Learn the character model of docs(doc_id, text), and the telling terms and their weights of a bounded sample of labelled rows."""
    sample = training_rows(labels, "toxic", 4, 2, rows)
    model = character_model(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, str] = {}
        for batch in blocks(batches, "text"):
            text = pa.array([restore(t or "", model, cache) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([text, batch.column("label")], ["text", "label"])

    learned = materialize(texts.mapInArrow(restored, "text string, label int"))

    def held_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in blocks(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                count[label == 1].update(terms(text))
        keys = list(count[0].keys() | count[1].keys())
        yield pa.RecordBatch.from_pydict({"term": keys, "clean": [count[0][k] for k in keys], "toxic": [count[1][k] for k in keys]}, pa.schema([("term", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))

    held = learned.mapInArrow(held_terms, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    telling = held.where((F.col("toxic") >= LEAST) & (F.col("toxic") > 2 * F.col("clean")))
    scorer = Scorer(model, sorted(r["term"] for r in telling.select("term").collect()))  # bounded by the sample

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            found = [scorer.of_restored(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["label", "held"])

    seen = learned.mapInArrow(find, "label int, held array<int>").groupBy("label", "held").count().collect()  # bounded by the sample
    rows_of = [(r["label"] == 1, list(r["held"])) for r in sorted(seen, key=lambda r: (r["label"], r["held"])) for _ in range(r["count"])]
    scorer.fit([h for _, h in rows_of], np.array([y for y, _ in rows_of], float))
    return scorer


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row of docs(doc_id, text)."""
    scorer = docs.sparkSession.sparkContext.broadcast(train(docs, labels, train_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            score = [scorer.value.score(t or "") for t in batch.column("text").to_pylist()]
            predicted = pa.array([int(s >= threshold) for s in score], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), predicted], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that are not predicted toxic, with all their columns."""
    scorer = docs.sparkSession.sparkContext.broadcast(train(docs, labels, train_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            yield batch.filter(pa.array([scorer.value.score(t or "") < threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_toxicity(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE: dict[str, str] = {}
