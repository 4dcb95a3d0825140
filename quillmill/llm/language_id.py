"""Language identification by cross-parsing against labelled text.

For each language a suffix automaton recognises exactly the substrings of a bounded sample of
its labelled text. A text is parsed into phrases, each the longest match from where the last
one ended; the fewer phrases a language needs for it, the better it fits. Counts are
normalised to bits per letter: phrases * log2(length of the sample) / letters.

The automata become displaced rows, a few cells a transition however large the alphabet is, and
whole batches walk them in step, one lane for each block of text and language, so the cost per
character is a table look-up. Blocks are first parsed as if a phrase began with each; then those that
begin within a phrase are parsed again from there, up to the place from which on both parses agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from quillmill.llm.words import pieces
from quillmill.session import ship

SAMPLE_ROWS = 256
"""Training rows of a language at most: whole texts, those whose doc_id hashes lowest."""
SAMPLE_CHARS = 64_000
"""Rows are taken until they have as many characters together."""
LONG_TEXT = 4_000
"""Texts with more characters are learned from only where a language has too few shorter ones."""
SAMPLE_LANGUAGES = 500
"""Languages of the sample: those with the most labelled rows."""
BLOCK = 512
"""Characters a lane parses. A phrase that a block begins within is carried over from the block before."""
WINDOW = 4096
"""Places tried at a time for a row of transitions."""
UNKNOWN = "und"


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads the substrings of `text` and no others."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p != -1:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(follow)
                follow.append(dict(follow[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and follow[p].get(c) == q:
                    follow[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return follow


def displaced_rows(follow: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All transitions in one array of cells, and where each state begins in it.

    The transition of a state that begins at b for letter c is cell b + c: its upper half has b
    (any other value says that there is none), the lower half where the next state begins.
    Rows overlap, so cells grow with the transitions, not with states x letters.
    """
    many = sorted((s for s, steps in enumerate(follow) if len(steps) > 1), key=lambda s: -len(follow[s]))
    one = np.array([s for s, steps in enumerate(follow) if len(steps) == 1], np.int64)
    none = np.array([s for s, steps in enumerate(follow) if not steps], np.int64)
    letter = np.array([next(iter(follow[s])) for s in one.tolist()], np.int64)
    starts = np.zeros(len(follow), np.int64)
    used, begun = np.zeros(4 * WINDOW + 2 * width, bool), np.zeros(4 * WINDOW + 2 * width, bool)
    low = 0
    for s in many:
        letters = list(follow[s])
        while True:
            if low + WINDOW + width > len(used):
                used, begun = (np.append(x, np.zeros(len(x), bool)) for x in (used, begun))
            taken = begun[low : low + WINDOW].copy()
            for c in letters:
                taken |= used[low + c : low + c + WINDOW]
            at = int(taken.argmin())
            if not taken[at]:
                break
            low += WINDOW // 2
        starts[s] = low + at
        begun[low + at] = True
        used[low + at + np.array(letters)] = True
    fresh = 0  # single transitions fill the gaps; what is left after a few rounds goes behind all others
    for attempt in range(len(one) + 8):
        if not len(one):
            break
        if attempt >= 7:
            fresh = int(np.flatnonzero(begun | used)[-1]) + width + 1 if (begun | used).any() else width
        if np.count_nonzero(~used[fresh:]) < len(one) + 1:
            used, begun = (np.append(x, np.zeros(max(0, fresh - len(x)) + 2 * len(one) + width, bool)) for x in (used, begun))
        cells = fresh + np.flatnonzero(~used[fresh:])[: len(one)]
        begin = cells - letter
        _, first = np.unique(begin, return_index=True)
        good = np.zeros(len(one), bool)
        good[first] = True
        good &= (begin >= 0) & ~begun[begin]
        starts[one[good]] = begin[good]
        used[cells[good]] = begun[begin[good]] = True
        turn = np.random.default_rng(attempt).permutation(np.count_nonzero(~good))
        one, letter = one[~good][turn], letter[~good][turn]
    begun = np.append(begun, np.zeros(len(none), bool))
    starts[none] = np.flatnonzero(~begun)[: len(none)]
    size = int(starts.max()) + width
    if size >= 2**31:
        raise OverflowError(f"{size} cells are too many for 32-bit places")
    table = np.full(size, -1, np.int64)
    begin = np.repeat(starts, [len(steps) for steps in follow])
    letters = np.fromiter((c for steps in follow for c in steps), np.int64, len(begin))
    to = np.fromiter((t for steps in follow for t in steps.values()), np.int64, len(begin))
    table[begin + letters] = begin << 32 | starts[to]
    return table, starts


class Alphabet:
    """Letters of the training text in lower case as 1, 2, ...; 0 is anything but a letter, the last one any other letter."""

    def __init__(self, texts: list[str]) -> None:
        letters = sorted({c for text in texts for c in text.lower() if c.isalpha()})
        self.size = len(letters) + 2
        self.codes = np.full(0x110000, -1, np.int32)
        self.place = {c: i + 1 for i, c in enumerate(letters)}

    def encode(self, text: bytes) -> np.ndarray:
        points = np.frombuffer(text.decode().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes[points]
        if (codes < 0).any():
            for point in np.unique(points[codes < 0]).tolist():
                c = chr(point)
                self.codes[point] = self.place.get(c.lower(), self.size - 1) if c.isalpha() else 0
            codes = self.codes[points]
        return codes

    def parse_form(self, codes: np.ndarray) -> np.ndarray:
        """Runs of non-letters as one."""
        return codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))] if len(codes) else codes


class CrossParser:
    """Tables for `(language, text)` pairs; a state is the place where its row begins in its language's table."""

    def __init__(self, samples: list[tuple[str, str]]) -> None:
        samples = sorted(samples)
        self.languages = [language for language, _ in samples]
        self.alphabet = Alphabet([text for _, text in samples])
        self.tables, self.starts, self.roots, self.weights = [], [], [], []
        self.lacks = []
        for _, text in samples:
            codes = self.alphabet.parse_form(self.alphabet.encode(text.encode()))
            follow = suffix_automaton(codes.tolist())
            table, places = displaced_rows(follow, self.alphabet.size)
            start = np.full(self.alphabet.size, places[0], np.int32)  # a phrase ends; the next one starts here
            start[list(follow[0])] = places[list(follow[0].values())]
            self.tables.append(table)
            self.starts.append(start)
            self.lacks.append(start == places[0])  # letters that are a phrase of their own
            self.roots.append(int(places[0]))
            self.weights.append(np.log2(max(2, len(codes))))
        self.weights = np.array(self.weights)

    def step(self, language: int, state: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one letter each, and how many phrases it ends: the one before it, and its own if it is unknown."""
        cell = self.tables[language][state + letters]
        ended = cell >> 32 != state  # no phrase goes on
        alone = ended & self.lacks[language][letters] & (state != self.roots[language])
        return np.where(ended, self.starts[language][letters], cell & 0xFFFFFFFF), ended.astype(np.int32) + alone

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each language needs for each text."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        sizes = np.array([-(-len(text) // BLOCK) for text in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        if not len(owner) or not self.languages:
            return total
        lanes = np.zeros((len(owner), BLOCK), np.int32)
        lengths = np.full(len(owner), BLOCK)
        at = 0
        for text, n in zip(texts, sizes.tolist(), strict=True):
            lanes[at : at + n].reshape(-1)[: len(text)] = text
            at += n
            if n:
                lengths[at - 1] = len(text) - (n - 1) * BLOCK
        order = np.argsort(-lengths, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        starts_of, sizes_of = owner, lengths
        lanes, lengths = np.ascontiguousarray(lanes[order].T), lengths[order]
        alive = len(lengths) - np.cumsum(np.bincount(lengths, minlength=BLOCK + 1))
        goes_on = np.flatnonzero(np.append(False, starts_of[1:] == starts_of[:-1])) if len(starts_of) else np.zeros(0, np.int64)
        for language, root in enumerate(self.roots):
            state = np.full(len(owner), root, np.int64)
            count = np.zeros(len(owner), np.int64)
            for k in range(BLOCK):
                n = alive[k]
                if not n:
                    break
                state[:n], more = self.step(language, state[:n], lanes[k, :n])
                count[:n] += more
            ends, counts = np.empty_like(state), np.empty_like(count)
            ends[order], counts[order] = state, count
            counts += self._carried(language, ends, lanes, place, sizes_of, goes_on)
            last = np.append(starts_of[1:] != starts_of[:-1], True)
            counts += last & (ends != root)
            total[:, language] = np.bincount(starts_of, counts, len(texts)).astype(np.int64)
        return total

    def _carried(self, language, ends, lanes, place, lengths, goes_on) -> np.ndarray:
        """What counts change by where blocks begin within a phrase; puts right the states that they end in.

        `ends` are the states after parses from the root. Block i is lane place[i].
        """
        root = self.roots[language]
        own, change = ends.copy(), np.zeros(len(ends), np.int64)
        begun = np.full(len(ends), root, np.int64)
        while True:
            fresh = goes_on[ends[goes_on - 1] != begun[goes_on]]
            if not len(fresh):
                return change
            begun[fresh] = ends[fresh - 1]
            change[fresh], ends[fresh] = 0, own[fresh]
            left, here, there = fresh[begun[fresh] != root], begun[fresh][begun[fresh] != root], None
            there = np.full(len(left), root, np.int64)
            for k in range(BLOCK):
                done = k >= lengths[left]
                ends[left[done]] = here[done]
                open_ = ~done & (here != there)
                left, here, there = left[open_], here[open_], there[open_]
                if not len(left):
                    break
                letters = lanes[k, place[left]]
                here, more = self.step(language, here, letters)
                there, less = self.step(language, there, letters)
                change[left] += more - less
            else:
                differ = here != there
                ends[left[differ]] = here[differ]


@lru_cache(maxsize=1)
def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(list(samples))


def _predictor(samples, carry: bool, names: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(tuple(samples.value))
        for batch in batches:
            for start, texts in pieces(batch):
                codes = [parser.alphabet.encode(text) for text in texts]
                letters = np.array([np.count_nonzero(one) for one in codes])
                counts = parser.phrases([parser.alphabet.parse_form(one) for one in codes])
                languages, scores = [], []
                for n, row in zip(letters.tolist(), counts, strict=True):
                    if not n or not parser.languages:
                        languages.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    bits = row * parser.weights / n
                    best = int(np.argmin(bits))
                    second = np.partition(bits, 1)[1] if len(bits) > 1 else parser.weights[0]
                    languages.append(parser.languages[best])
                    scores.append(float(min(1.0, max(0.0, 1 - bits[best] / second))))
                part = batch.slice(start, len(texts))
                carried = [name for name in batch.schema.names if name != "text" or carry]
                yield pa.RecordBatch.from_arrays(
                    [*part.select(carried).columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                    [*carried, *names])
    return predict


def language_samples(
    labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, languages: int = SAMPLE_LANGUAGES
) -> list[tuple[str, str]]:
    """`(lang, text)` of each label: whole texts of at most `rows` rows, chosen by a hash of doc_id until they have
    `chars` characters together; texts above `LONG_TEXT` come last.

    Rows without label or letters teach nothing. Of more than `languages` labels those with the most rows are learned
    (ties: by code point). This bounds the model only; predictions read whole texts.
    """
    place, before, size = "place in the sample", "characters before", "characters"
    some = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", "doc_id")
    most = some.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    some = some.select(
        "lang", "text", F.length("text").alias(size), F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)).alias("pick"))
    best = Window.partitionBy("lang").orderBy(F.col(size) > LONG_TEXT, "pick", "text")
    some = some.withColumn(place, F.row_number().over(best)).where(F.col(place) <= rows)
    told = F.sum(size).over(Window.partitionBy("lang").orderBy(place).rowsBetween(Window.unboundedPreceding, -1))
    some = some.withColumn(before, F.coalesce(told, F.lit(0))).where(F.col(before) < chars)
    texts = some.groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("text"))
    return sorted(tuple(row) for row in texts.join(most, "lang").collect())


def identify_languages(docs: DataFrame, samples: list[tuple[str, str]], carry: bool = False) -> DataFrame:
    """`doc_id, lang_pred, score` for every row of `docs`, from its text alone.

    `score` is how far the next best language is behind: 1 - bits / bits of the next (0 to 1).
    Ties go to the first language by code point. A text that is null, empty or without letters
    (or no sample at all) gives `und` and 0. Equal rows give equal rows; other columns are not
    looked at. With `carry` the result has all columns of `docs`, then `predicted language` and `its score`.
    """
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast(samples)
    names = ["predicted language", "its score"] if carry else ["lang_pred", "score"]
    given = docs if carry else docs.select("doc_id", "text")
    out = StructType([field for field in given.schema if field.name != "text" or carry])
    out = out.add(names[0], StringType()).add(names[1], DoubleType())
    return given.mapInArrow(_predictor(sent, carry, names), out)
