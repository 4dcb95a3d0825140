"""Byte-level BPE encoding and decoding as DuckDB queries inside each task.

A text is cut by the tokenizer's pattern. The words a task has not met before go through one
recursive query: rows of (word, position, token) join the merge table, each word's lowest
rank is found, its pairs of that rank are contracted from the left, and words without a pair
left drop out, until none is left. Decoding joins tokens with their bytes and aggregates in order.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quillmill.llm.words import pieces
from quillmill.session import ship

WORDS_AT_ONCE = 20_000
"""Words of one recursive query."""
BYTES_AT_ONCE = 200_000
"""Bytes of one recursive query (a longer word has one to itself)."""
WORDS_KEPT = 400_000
"""Words and pieces a worker remembers the tokens of; it then forgets them all and goes on."""
SPACE_SAFE = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)
"""Patterns (fixed values) whose matches end before every space that is followed by no white space."""
DECODED_AT_ONCE = 256
"""Texts of one decoding query."""
LONG_WORD = 64
"""Bytes above which a word's pairs of lowest rank are contracted all at once, not one a step."""

# Leftmost pair of lowest rank first. Rank, place and width of a pair share one integer, so the
# smallest is the pair to take. Places leave a gap between words.
_CONTRACT = """
WITH RECURSIVE state AS (
    SELECT word, pos, id, 1 AS len, false AS whole FROM tokens
    UNION ALL
    SELECT s.word, s.pos, CASE WHEN s.pos = b.pos THEN b.id ELSE s.id END, CASE WHEN s.pos = b.pos THEN b.len ELSE s.len END, b.pos IS NULL
    FROM (SELECT * FROM state WHERE NOT whole) AS s LEFT JOIN (
        SELECT word, (min(pair) >> 36)::INT AS id, ((min(pair) >> 8) & 268435455)::INT AS pos, (min(pair) & 255)::INT AS len FROM (
            SELECT x.word, (m.id::BIGINT << 36) + (x.pos::BIGINT << 8) + x.len + y.len AS pair
            FROM (SELECT *, pos + len AS following FROM state WHERE NOT whole) AS x
            JOIN (SELECT pos, id, len FROM state WHERE NOT whole) AS y ON y.pos = x.following
            JOIN merges AS m ON m.pair = (x.id::BIGINT << 32) + y.id
        ) GROUP BY word
    ) AS b ON b.word = s.word
    WHERE b.pos IS NULL OR s.pos <= b.pos OR s.pos >= b.pos + b.len
)
SELECT word, id FROM state WHERE whole ORDER BY pos
"""
# The same for long words: of a run of pairs of the lowest rank every other one goes in a step.
_CONTRACT_ALL = """
WITH RECURSIVE state AS (
    SELECT word, pos, id, 0 AS step, false AS whole FROM tokens
    UNION ALL
    SELECT word, pos, CASE WHEN taken THEN rank ELSE id END AS id, step + 1 AS step, low IS NULL
    FROM (
        SELECT *, coalesce(lag(taken) OVER spot, false) AS gone FROM (
            SELECT *, hit AND (seq - coalesce(max(CASE WHEN NOT hit THEN seq END) OVER so_far, 0)) % 2 = 1 {only} AS taken FROM (
                SELECT *, coalesce(rank = low, false) AS hit FROM (
                    SELECT p.*, m.id AS rank, min(m.id) OVER (PARTITION BY p.word) AS low FROM (
                        SELECT word, pos, id, step, lead(id) OVER one AS following, row_number() OVER one AS seq
                        FROM state WHERE NOT whole WINDOW one AS (PARTITION BY word ORDER BY pos)
                    ) AS p LEFT JOIN merges AS m ON m.pair = (p.id::BIGINT << 32) + p.following
                )
            ) WINDOW so_far AS (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING)
        ) WINDOW spot AS (PARTITION BY word ORDER BY pos)
    ) WHERE NOT gone
)
SELECT word, id FROM state WHERE whole ORDER BY pos
"""
_FIRST_ONLY = "AND pos = min(CASE WHEN hit THEN pos END) OVER (PARTITION BY word)"
# A token's bytes are the characters of the same numbers.
_DECODE = """
SELECT text, string_agg(bytes, '') AS bytes FROM (SELECT text, bytes FROM ids JOIN vocabulary USING (id) ORDER BY pos)
GROUP BY text
"""
Batches = Iterator[pa.RecordBatch]


def read_ranks(ranks: bytes) -> dict[bytes, int]:
    """Tokens of a rank file (base64 token and rank a line)."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}


def merge_table(ranks: dict[bytes, int]) -> np.ndarray:
    """The rows (left, right, merged) of all merges, worked out once for all tasks."""
    found = [(*parts, rank) for token, rank in ranks.items() if (parts := last_pair(ranks, token))]
    return np.array(found, np.int32).reshape(-1, 3)


def last_pair(ranks: dict[bytes, int], token: bytes) -> tuple[int, int] | None:
    """The one pair from which merging makes this token (None for bytes, and where it never does).

    Merges run by rank and place, so within the token's bytes they run as they would alone.
    """
    parts = [token[i : i + 1] for i in range(len(token))]
    never = len(ranks) + 2**31
    while len(parts) > 2:
        found = [ranks.get(a + b, never) for a, b in zip(parts[:-1], parts[1:], strict=True)]
        low = min(found)
        if low == never:
            return None
        k = found.index(low)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None


class ByteBPE:
    """A rank file and a pattern, as DuckDB tables."""

    def __init__(self, ranks: bytes, pattern: str, merges: np.ndarray | None = None) -> None:
        self.ranks = read_ranks(ranks)
        self.find = regex.compile(pattern).findall
        # the cut at spaces is sound for this family of patterns only; others take whole texts
        self.uneven = regex.compile(r" (?=\s|$)").search if pattern in SPACE_SAFE else bool
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = (merge_table(self.ranks) if merges is None else merges).T
        # Where every merge ranks above its parts, all pairs of a word's lowest rank can go in one
        # step: what they make ranks higher and has to wait for them anyway.
        self.long_query = _CONTRACT_ALL.format(only="" if (np.maximum(left, right) < merged).all() else _FIRST_ONLY)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB"})
        self._put("merges", pair=(left.astype(np.int64) << 32) + right, id=merged, keep=True)
        names = list(self.ranks)
        self._put("vocabulary", id=np.array([self.ranks[t] for t in names], np.int32), bytes=[t.decode("latin-1") for t in names], keep=True)

    def _put(self, name: str, keep: bool = False, **columns) -> None:
        table = pa.table(columns)
        if keep:
            self.db.register("incoming", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.db.unregister("incoming")
        else:
            self.db.register(name, table)

    def learn(self, words: list[str]) -> None:
        """Find the tokens of words that are new; each as little-endian 32-bit ids."""
        raw = [word.encode() for word in words]
        for word, data in zip(words, raw, strict=True):
            if data in self.ranks:
                self.known[word] = np.array([self.ranks[data]], "<u4").tobytes()
        hard = [(word, data) for word, data in zip(words, raw, strict=True) if data not in self.ranks]
        for some, query in (
            ([one for one in hard if len(one[1]) <= LONG_WORD], _CONTRACT), ([one for one in hard if len(one[1]) > LONG_WORD], self.long_query),
        ):
            start = 0
            while start < len(some):
                stop, size = start, 0
                while stop < len(some) and stop - start < WORDS_AT_ONCE and (stop == start or size + len(some[stop][1]) <= BYTES_AT_ONCE):
                    size += len(some[stop][1])
                    stop += 1
                self._contract(some[start:stop], query)
                start = stop

    def _contract(self, hard: list[tuple[str, bytes]], query: str) -> None:
        sizes = np.array([len(data) for _, data in hard])
        data = np.frombuffer(b"".join(data for _, data in hard), np.uint8)
        word = np.repeat(np.arange(len(hard), dtype=np.int32), sizes)
        self._put("tokens", word=word, pos=np.arange(len(data), dtype=np.int32) + word, id=self.byte[data])
        found = self.db.sql(query).to_arrow_table()
        ids = found.column("id").to_numpy().astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(found.column("word").to_numpy(), minlength=len(hard)))
        for (one, _), a, b in zip(hard, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            self.known[one] = ids[a:b]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Token ids of each text, as little-endian 32-bit integers.

        The pattern never matches across a space that stands alone before something else than
        white space. So a text is first cut there, and each distinct piece goes through the pattern
        once. Texts with other white space after a space, or at the end, go through it as a whole.
        """
        if len(self.known) + len(self.spaced) > WORDS_KEPT:
            self.known.clear()
            self.spaced.clear()
        cut, pieces_ = [], {}
        for text in texts:
            text = text.decode()
            if self.uneven(text):
                cut.append(([text], None))
            else:
                first, *rest = text.split(" ")
                cut.append(([first], rest))
                pieces_.update(dict.fromkeys(rest))
        new = [piece for piece in pieces_ if piece not in self.spaced]
        found = [self.find(" " + piece) for piece in new]
        whole = [self.find(first[0]) for first, _ in cut]
        words = dict.fromkeys(word for words in (*found, *whole) for word in words if word not in self.known)
        self.learn(list(words))
        known, spaced = self.known.__getitem__, self.spaced
        for piece, words in zip(new, found, strict=True):
            spaced[piece] = b"".join(map(known, words))
        return [b"".join([*map(known, words), *map(spaced.__getitem__, rest or ())]) for words, (_, rest) in zip(whole, cut, strict=True)]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids; an id that the vocabulary lacks is an error."""
        sizes = np.array([len(ids) // 4 for ids in encoded], np.int64)
        ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
        self._put("ids", text=np.repeat(np.arange(len(encoded), dtype=np.int32), sizes), pos=np.arange(len(ids), dtype=np.int32), id=ids)
        ((known,),) = self.db.sql("SELECT count(*) FROM ids SEMI JOIN vocabulary USING (id)").fetchall()
        if known != len(ids):
            raise ValueError("an id that the vocabulary lacks")
        out = [b""] * len(encoded)
        found = self.db.sql(_DECODE).to_arrow_table()
        for text, raw in zip(found.column("text").to_pylist(), found.column("bytes").to_pylist(), strict=True):
            out[text] = raw.encode("latin-1")
        return out


@lru_cache(maxsize=2)
def _coder(ranks: bytes, pattern: str, merges: bytes) -> ByteBPE:
    return ByteBPE(ranks, pattern, np.frombuffer(merges, np.int32).reshape(-1, 3))


def _sent(spark: SparkSession, path: str, pattern: str):
    """The tokenizer for all tasks: one file of ranks, and the merges, which are no more than its tokens."""
    with open(path, "rb") as file:
        ranks = file.read()
    return spark.sparkContext.broadcast((ranks, pattern, merge_table(read_ranks(ranks)).tobytes()))


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, decode: bool = False, then: tuple[Callable[[Batches], Batches], str] | None = None,
) -> DataFrame:
    """`doc_id, ids` for every row of `docs`: the token ids of its whole text, as array<int>.

    The rank file is read on the driver and sent to the executors. No special tokens: their
    strings are ordinary text. A null or empty text has no ids. Equal rows give equal rows;
    other columns are not looked at. With `decode` the ids are decoded again on the way, as
    `decode_ids` does: one more column, `decoded`, and one worker with these tables, not two.
    `then` is a step over the result's batches in the same worker, and the columns it gives.
    """
    spark = ship(docs.sparkSession)
    sent = _sent(spark, ranks_path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*sent.value)
        for batch in batches:
            for start, texts in pieces(batch):
                encoded = coder.encode(texts)
                ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
                cuts = np.cumsum([0, *(len(one) // 4 for one in encoded)]).astype(np.int32)
                columns = [batch.column("doc_id").slice(start, len(texts)), pa.ListArray.from_arrays(cuts, ids)]
                if decode:
                    parts = (encoded[i : i + DECODED_AT_ONCE] for i in range(0, len(encoded), DECODED_AT_ONCE))
                    columns.append(pa.array([raw for part in parts for raw in coder.decode(part)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    kind = f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>" + ", decoded binary" * decode
    if then:
        step, kind = then
        return docs.select("doc_id", "text").mapInArrow(lambda batches: step(encode(batches)), kind)
    return docs.select("doc_id", "text").mapInArrow(encode, kind)


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`doc_id, ids, decoded` for every row of `encoded` (doc_id, ids): the bytes its ids stand for.

    Null or empty ids give empty bytes. Bytes need not be whole characters, so they stay binary.
    """
    spark = ship(encoded.sparkSession)
    sent = _sent(spark, ranks_path, pattern)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_AT_ONCE):
                part = batch.slice(start, DECODED_AT_ONCE)
                raw = [b"" if one is None else one.astype("<u4").tobytes() for one in part.column("ids").to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays(
                    [*part.select(["doc_id", "ids"]).columns, pa.array(coder.decode(raw), pa.binary())], ["doc_id", "ids", "decoded"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, ids array<int>, decoded binary")
