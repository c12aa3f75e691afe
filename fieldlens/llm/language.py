"""Language identification by cross-parsing entropy.

A suffix automaton is built of a bounded sample of labelled text for each language. A text is parsed into phrases,
each the longest match that some place of the sample continues (a letter that the sample lacks begins a phrase); the
language that needs the fewest phrases, normalised as phrases * log2(sample length) / text length, wins. Every letter of
the samples is a symbol of its own. Automata are laid out in one array: the transition of state s by symbol c stands at
s + c, beside s, so thousands of places advance by one character in a few numpy steps, and a missing transition leads to
where the root leads by that character and begins a phrase.

A text is parsed whole. Segments of ``SEGMENT`` characters are parsed side by side as if each began anew; then each is parsed
again from the state in which the one before it ended, until both ways meet. The phrases are those of a parse from end to end.

The sample: doc_ids fall into ``SAMPLE_ROWS`` classes by a hash, and of each class the labelled document of a language with the least hash
may be learned; whole texts of these, as far as they fit into ``SAMPLE_CHARS``. Where none fits, the first of them is cut at that length.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any labelled row every text
is ``und``; near-equal entropies, as of a few letters, are told apart by letter frequencies, equal ones go to the language first in
order; a doc_id that several rows share is learned once for each language, with its least text; repeated rows each keep a row;
an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import read
from fieldlens.llm._text import blocks
from fieldlens.llm.quality import held_out

SAMPLE_ROWS, SAMPLE_CHARS = 128, 60_000
SEGMENT = 256
NEAR = 0.01  # weight of letter frequencies, which only tell near-equal entropies apart
WIDTH = 8192  # segments parsed together
UNDETERMINED = "und"


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of each state of the automaton of all substrings."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return step


def laid_out(step: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each state stands, no two alike, and the array of transitions: at where(s) + c, ``where(s) << 32 | where(to)``, or -1."""
    taken, used, where = bytearray(3 * len(step) + 2 * width), set(), [0] * len(step)
    low = tries = top = 0
    for state in sorted(range(len(step)), key=lambda s: -len(step[s])):
        symbols = sorted(step[state])
        first, rest = (symbols[0], symbols[1:]) if symbols else (0, [])
        at = max(low, first)
        while True:
            at = taken.find(0, at) if symbols else at
            base = at - first
            if base not in used and not any(taken[base + c] for c in rest):
                break
            at += 1
            tries += 1
            if tries > 64:  # the slots from here on were tried often enough
                low, tries = max(low, at - 256), 0
        used.add(base)
        where[state] = base
        for c in symbols:
            taken[base + c] = 1
        top = max(top, base)
        if len(taken) < top + 2 * width:
            taken.extend(bytes(len(taken) // 2))
    places = np.array(where, np.int64)
    moves = np.full(int(places.max()) + width, -1, np.int64)
    for state, to in enumerate(step):
        for c, target in to.items():
            moves[where[state] + c] = where[state] << 32 | where[target]
    return places, moves


def language_table(symbols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For one sample: where a phrase that begins with each symbol stands (at the root, where the sample lacks it), and the transitions."""
    step = suffix_automaton(symbols.tolist())
    where, moves = laid_out(step, width)
    begins = np.full(width, where[0], np.int64)
    begins[list(step[0])] = where[list(step[0].values())]
    return begins, moves


def built_by_executors(spark: SparkSession) -> Callable[[dict[str, np.ndarray], int], dict[str, tuple[np.ndarray, np.ndarray]]]:
    """A function that makes the tables of all languages side by side, a task for each."""

    def tables(symbols: dict[str, np.ndarray], width: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, held in zip(batch.column("lang").to_pylist(), batch.column("symbols").to_pylist()):
                    begins, moves = language_table(np.frombuffer(held, np.int32), width)
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "begins": [begins.tobytes()], "moves": [moves.tobytes()]})

        rows = [(lang, bytearray(held.astype(np.int32).tobytes())) for lang, held in symbols.items()]
        if not rows:
            return {}
        made = spark.createDataFrame(rows, "lang string, symbols binary").repartition(len(rows)).mapInArrow(run, "lang string, begins binary, moves binary")
        return {r["lang"]: (np.frombuffer(r["begins"], np.int64), np.frombuffer(r["moves"], np.int64)) for r in made.collect()}  # bounded by SAMPLE_CHARS

    return tables


def built_here(symbols: dict[str, np.ndarray], width: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    return {lang: language_table(held, width) for lang, held in symbols.items()}


class Parser:
    """Cross-parsing tables of all languages: entropies of many texts at once."""

    def __init__(self, samples: dict[str, str], tables_of: Callable = built_here):
        self.languages = sorted(samples)
        codes = {lang: _codes(samples[lang]) for lang in self.languages}
        every, counts = np.unique(np.concatenate([*codes.values(), np.zeros(0, np.uint32)]), return_counts=True)
        lettered = np.array([chr(c).isalpha() for c in every], bool)
        letters = every[lettered][np.argsort(-counts[lettered], kind="stable")]
        # symbol 0: no letter; 1: a letter that the samples lack
        self.width = 2 + len(letters)
        self.symbol = np.zeros(0x110000, np.int32)
        if self.languages:
            self.symbol[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
        self.symbol[letters] = np.arange(2, self.width)
        tables, roots, first, self.bits, single, offset = [], [], [], [], [], 0
        symbols_of = {lang: self.squeeze(self.symbol[codes[lang]]) for lang in self.languages}
        made = tables_of(symbols_of, self.width)
        for lang in self.languages:
            symbols, (begins, moves) = symbols_of[lang], made[lang]
            tables.append(np.where(moves >= 0, moves + (offset << 32 | offset), -1))
            roots.append(begins[1] + offset)  # no sample has symbol 1
            first.append(begins + offset)
            offset += len(moves)
            shares = np.bincount(symbols, minlength=self.width) + 0.5
            single.append(-np.log2(shares / shares.sum()))
            self.bits.append(float(np.log2(max(2, len(symbols)))))
        self.single = np.array(single).reshape(len(single), self.width)
        self.moves = np.concatenate([*tables, np.full(self.width, -1, np.int64)])
        self.roots, self.first = np.array(roots, np.int64), np.concatenate([*first, np.zeros(0, np.int64)])

    def advance(self, state: np.ndarray, symbol: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one symbol, and where it begins a phrase."""
        move = self.moves[state + symbol]
        new = (move >> 32) != state
        return np.where(new, self.first[lang * self.width + symbol], move & 0xFFFFFFFF), new

    @staticmethod
    def squeeze(symbols: np.ndarray) -> np.ndarray:
        """One symbol for a run that holds no letters."""
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
        return symbols[keep]

    def _walk(self, seg: int, lane: int, flat, first, length, within, begun, ended, count) -> None:
        """Parse on from the end of the segment before ``seg`` until that comes to the states found before."""
        moves, firsts, base = memoryview(self.moves), memoryview(self.first), lane * self.width
        now = int(ended[seg - 1, lane])
        while seg < len(within) and within[seg]:
            old, change = int(begun[seg, lane]), 0
            begun[seg, lane] = now
            for symbol in flat[first[seg] : first[seg] + length[seg]].tolist():
                if old == now:
                    break
                move = moves[old + symbol]
                if move >> 32 == old:
                    old = move & 0xFFFFFFFF
                else:
                    old, change = firsts[base + symbol], change - 1
                move = moves[now + symbol]
                if move >> 32 == now:
                    now = move & 0xFFFFFFFF
                else:
                    now, change = firsts[base + symbol], change + 1
            count[seg, lane] += change
            if old == now:
                return
            ended[seg, lane] = now
            seg += 1

    def phrases(self, flat: np.ndarray, starts: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """The number of phrases of each text flat[starts[i] : starts[i + 1]] for each language."""
        sizes = np.diff(starts)
        number = -(-sizes // segment)
        owner = np.repeat(np.arange(len(sizes)), number)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        first = starts[owner] + within * segment
        length = np.minimum(segment, starts[owner + 1] - first) if len(owner) else np.zeros(0, np.int64)
        order = np.argsort(-length, kind="stable")
        k = len(self.languages)
        begun = np.repeat(self.roots[None, :], len(owner), 0)  # the state from which a segment was parsed
        ended, count = begun.copy(), np.zeros((len(owner), k), np.int64)
        lang = np.arange(k)[None, :]
        for at in range(0, len(order), WIDTH):
            seg = order[at : at + WIDTH]
            span = length[seg]
            state, new = begun[seg], np.zeros((len(seg), k), np.int32)
            for i in range(int(span[0])):
                live = int(np.searchsorted(-span, -i, "left"))  # longest first: those longer than i
                state[:live], flag = self.advance(state[:live], flat[first[seg[:live]] + i][:, None], lang)
                new[:live] += flag
            ended[seg], count[seg] = state, new
        apart = np.zeros(begun.shape, bool)

        def unlike() -> tuple[np.ndarray, np.ndarray]:
            """Segments that were not parsed from where the one before them ended, by language and place."""
            apart[1:] = (begun[1:] != ended[:-1]) & (within[1:] > 0)[:, None]
            return np.nonzero(apart.T)

        if len(owner):
            lane, seg = unlike()
            old, now = begun[seg, lane], ended[seg - 1, lane]
            begun[seg, lane] = now
            change, live, i = np.zeros(len(seg), np.int64), np.arange(len(seg)), 0
            while len(live):
                symbol, of = flat[first[seg[live]] + i], lane[live]
                old[live], a = self.advance(old[live], symbol, of)
                now[live], b = self.advance(now[live], symbol, of)
                change[live] += b.astype(np.int64) - a
                i += 1
                live = live[(old[live] != now[live]) & (i < length[seg[live]])]
            count[seg, lane] += change
            ended[seg, lane] = np.where(old == now, ended[seg, lane], now)
            while len((found := unlike())[0]):  # few are left, as where a text repeats its sample; they are walked in order
                lane, seg = found
                head = np.ones(len(seg), bool)
                head[1:] = (lane[1:] != lane[:-1]) | (owner[seg[1:]] != owner[seg[:-1]])
                for at, of in zip(seg[head].tolist(), lane[head].tolist()):
                    self._walk(at, of, flat, first, length, within, begun, ended, count)
        total = np.zeros((len(sizes), k), np.int64)
        np.add.at(total, owner, count)
        return total + 1

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character for each text and language, and whether the text has a letter."""
        parts = [self.squeeze(self.symbol[_codes(t)]) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        lettered = np.array([bool(p.any()) for p in parts], bool)
        flat = np.concatenate([*parts, np.zeros(0, np.int32)])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        bits = self.phrases(flat, starts) * np.array(self.bits)[None, :]
        for lang in range(len(self.languages)):
            summed = np.concatenate([[0.0], np.cumsum(self.single[lang][flat])])
            bits[:, lang] += NEAR * (summed[starts[1:]] - summed[starts[:-1]])
        return bits / np.maximum(sizes, 1)[:, None], lettered

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bits, lettered = self.entropies(texts)
        best = bits.argmin(1)
        low = bits[np.arange(len(texts)), best]
        bits[np.arange(len(texts)), best] = np.inf
        next_low = bits.min(1) if bits.shape[1] > 1 else np.full(len(texts), np.inf)
        score = np.where(lettered, np.where(np.isinf(next_low), 1.0, 1 - low / np.maximum(next_low, 1e-12)), 0.0)
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)], np.clip(score, 0, 1)


def training_samples(docs: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """A bounded sample of text for each language of docs(doc_id, text, lang)."""
    labelled = docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), "text").where("lang is not null and length(text) > 0")
    of = F.xxhash64("doc_id")
    least = labelled.groupBy("lang", F.pmod(of, F.lit(SAMPLE_ROWS)).alias("k")).agg(F.min(F.struct(of.alias("h"), "doc_id", F.length("text").alias("n"))).alias("r"))
    rows = sorted(least.select("lang", "r.h", "r.doc_id", "r.n").collect(), key=lambda r: (r["lang"], r["h"]))  # SAMPLE_ROWS for each language at most
    left: dict[str, int] = {}
    chosen: dict[str, list] = {}
    for r in rows:
        if r["n"] < left.setdefault(r["lang"], chars):
            left[r["lang"]] -= r["n"] + 1
            chosen.setdefault(r["lang"], []).append(r["doc_id"])
    for r in rows:
        chosen.setdefault(r["lang"], [r["doc_id"]])
    if not chosen:
        return {}
    wanted = docs.sparkSession.createDataFrame([(lang, i) for lang, ids in chosen.items() for i in ids], "wanted string, id long")
    some = labelled.join(F.broadcast(wanted), (F.col("lang") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("id")))
    texts = {(r["lang"], r["doc_id"]): r["text"] for r in some.groupBy("lang", "doc_id").agg(F.min(F.substring("text", 1, chars)).alias("text")).collect()}
    return {lang: "\n".join(texts[lang, i] for i in ids)[:chars] for lang, ids in chosen.items()}


def identify_language(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """Language of every row of docs(doc_id, text): doc_id, lang_pred, score."""
    parser = docs.sparkSession.sparkContext.broadcast(Parser(samples, built_by_executors(docs.sparkSession)))  # bounded by SAMPLE_CHARS for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            lang, score = parser.value.predict([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = training_samples(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return identify_language(docs, samples).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_language": op4_language}
ORACLE: dict[str, str] = {}
