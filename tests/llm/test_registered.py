"""The registered queries that SQL cannot express, on small whole tables, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from test_dedup import SPLIT, near_model, passage_model
from test_tables import target_model

from quillmill.llm import queries
from quillmill.llm.byte_bpe import read_ranks
from quillmill.llm.language_id import language_samples

ODD = r"\### Assistant: </turn> ok"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(11)
    sounds = {"aa": ["ka", "lo", "mi", "pe"], "bb": ["zu", "st", "ör", "pe"], "cc": ["qu", "è", "ch", "ka"]}
    out = []
    for i in range(90):
        lang = pick.choice(list(sounds))
        words = ["".join(pick.choices(sounds[lang], k=3)) + str(pick.randrange(40)) for _ in range(pick.randint(1, 90))]
        out.append((i, " ".join(words), lang if i % 9 else None, pick.choice(["web", "Web", "é", None])))
    for i in range(20):
        words = out[i][1].split(" ")
        words[pick.randrange(len(words))] = "edited"
        out.append((100 + i, " ".join(words), out[i][2], "web"))
    out += [(200, None, "aa", "web"), (201, "", None, None), (202, "1 -- 2", "bb", "web"), (203, out[3][1].upper() + "\n", None, "é")]
    return [*out, out[5], (None, out[7][1], "aa", "web")]


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4).write.parquet(f"{path}/documents.parquet")
    pick = random.Random(2)
    talks = [(c, t, pick.choice(["user", "assistant", "system", None]), pick.choice(["a ## b", "</turn>", "", None, "é\\", ODD]))
             for c in [*range(20), None] for t in range(pick.randint(1, 9))]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path), talks


def found(df):
    return Counter(tuple(row) for row in df.collect())


def test_op1(spark, tables):
    path, talks = tables
    said = defaultdict(list)
    for conv, turn, role, text in [*talks, (-7, 0, "user", ODD), (-7, 1, "assistant", ODD)]:
        said[conv].append((turn, role or "", text or ""))
    got = {row.conv_id: row for row in queries.op1_chat_format(spark, path).collect()}
    assert set(got) == set(said)
    for conv, turns in said.items():
        turns.sort()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        row = got[conv]
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
        assert row.formatted_chars >= sum(len("### : " " </turn>\n") + len(r) + len(t) for _, r, t in turns)
    assert got[-7].loss_chars == len(ODD)


def test_op2(spark, tables, rows):
    """Phrases by looking for substrings, letter by letter."""
    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    samples = language_samples(docs.where("doc_id IS NULL OR crc32(CAST(doc_id AS STRING)) % 5 <> 0"))
    codes = lambda text: "".join(c if c.isalpha() else " " for c in text.lower())
    squeezed = lambda text: re.sub(" +", " ", codes(text))
    samples = [(lang, squeezed(sample)) for lang, sample in samples]
    want = Counter()
    for doc_id, text, _, _ in rows:
        letters = sum(c != " " for c in codes(text or ""))
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        bits = []
        for lang, sample in samples:
            known, left, n = sample, squeezed(text or ""), 0
            while left:
                size = 1
                while size < len(left) and left[: size + 1] in known:
                    size += 1
                left, n = left[size:], n + 1
            bits.append((n * math.log2(len(known)) / max(1, letters), lang))
        (best, lang), (second, _) = sorted(bits)[:2]
        want[(doc_id, held, lang, round(min(1.0, max(0.0, 1 - best / second)), 9)) if letters else (doc_id, held, "und", 0.0)] += 1
    got = Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in queries.op2_language_id(spark, path).collect())
    assert got == want


def test_op5(spark, tables, rows):
    path, _ = tables
    with open(queries.RANKS, "rb") as file:
        peer = tiktoken.Encoding("peer", pat_str=queries.PATTERN, mergeable_ranks=read_ranks(file.read()), special_tokens={})
    want = Counter()
    for doc_id, text, _, _ in rows:
        ids = peer.encode_ordinary(text or "")
        want[doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text or "")] += 1
    assert found(queries.op5_byte_bpe(spark, path)) == want


def test_op6(spark, tables, rows):
    path, _ = tables
    named = [row[:2] for row in rows if row[0] is not None]
    want = near_model(named, 85)
    want[None, len(set(zip(*(SPLIT.findall(rows[-1][1].lower())[k:] for k in range(5))))), None, True] += 1
    assert found(queries.op6_near_dedup(spark, path)) == want


def test_op7(spark, tables, rows):
    path, _ = tables
    got = Counter(tuple(r) for r in queries.op7_substring_dedup(spark, path).collect() if r.doc_id is not None)
    model = passage_model([row[:2] for row in rows if row[0] is not None], 13)
    assert got == Counter({(i, n, gone, sha(kept)): count for (i, n, gone, kept), count in model.items()})


def test_op9(spark, tables, rows):
    path, _ = tables
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(SPLIT.findall(text or ""))
    targets = target_model(sizes)
    source_of = {row[0]: row[3] for row in rows}
    taken = Counter()
    got = queries.op9_mixing(spark, path).collect()
    assert Counter(r.doc_id for r in got) == Counter(row[0] for row in rows)
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and math.isclose(r.target, targets[source]) and r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 91 for s in sizes)
    assert found(queries.op9_mixing(spark, path)) == Counter(map(tuple, got))
