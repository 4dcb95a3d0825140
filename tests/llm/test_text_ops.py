import base64
import gzip
import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from quillmill.llm import byte_bpe, chat_format, language_id, warc
from quillmill.llm.queries import DIGESTS, PATTERN, RANKS, bpe_digests, digests, held_out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- chat --------------------------------------------------------------------------------------

ODD = st.text(alphabet="\\#/<>turn: \né", max_size=30)


@given(st.lists(st.tuples(ODD, ODD | st.just(r"\### Assistant: </turn> ok")), max_size=6))
def test_format_round_trip(turns):
    text, _ = chat_format.format_turns(turns)
    assert chat_format.parse_turns(text) == turns


@given(ODD)
def test_escaped_text_has_no_control_strings(text):
    kept = chat_format.escape(text)
    assert "##" not in kept and "</turn>" not in kept and chat_format.unescape(kept) == text


def test_a_broken_conversation_is_an_error():
    with pytest.raises(ValueError, match="not a formatted"):
        chat_format.parse_turns("### user: hi")


def test_threads(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} ## </turn>") for t in range(13)]
    rows += [(2, 5, "user", "gap"), (2, 900, "assistant", "späte\\"), (3, 0, "user", None), (3, 1, "assistant", ""), (4, 0, None, "x"),
             (5, 0, "user", "tie"), (5, 0, "assistant", "tie"), (5, 0, "user", "tie"), (None, 1, "assistant", "no id"), (None, 0, "user", "q"), (6, None, "user", "n")]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    got = {r.tree: r for r in chat_format.read_back(chat_format.format_trees(chat_format.as_threads(given))).collect()}
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn if turn is not None else -1, role or "", text or ""))
    assert set(got) == set(talks)
    for conv, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), sha(said))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))
    assert chat_format.format_trees(chat_format.as_threads(given.limit(0))).count() == 0


def test_trees(spark):
    """Branches, an orphan as a root of its own, and the best paths by score."""
    nodes = [(1, 1, None, 0.0), (1, 2, 1, 0.5), (1, 3, 1, 0.9), (1, 4, 3, 0.1), (1, 5, 3, None), (1, 6, 2, 1.0), (2, 9, 77, 0.0)]
    rows = [(t, n, p, [("user", f"m{n}")], s) for t, n, p, s in nodes]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, turns array<struct<role:string,text:string>>, score double")

    def said(df):
        return {(r.tree, r.leaf): [t for _, t in chat_format.parse_turns(r.formatted)] for r in df.collect()}

    paths = {(1, 4): ["m1", "m3", "m4"], (1, 5): ["m1", "m3", "m5"], (1, 6): ["m1", "m2", "m6"], (2, 9): ["m9"]}
    assert said(chat_format.format_trees(df)) == paths
    assert said(chat_format.format_trees(df, best=1)) == {k: paths[k] for k in [(1, 4), (2, 9)]}
    assert said(chat_format.format_trees(df, best=2)) == {k: paths[k] for k in [(1, 4), (1, 5), (2, 9)]}


def test_a_cycle_is_an_error(spark):
    rows = [(1, 1, 2, [("user", "a")], 0.0), (1, 2, 1, [("user", "b")], 0.0), (1, 3, 2, [("user", "c")], 0.0)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, turns array<struct<role:string,text:string>>, score double")
    with pytest.raises(ValueError, match="ancestor"):
        chat_format.format_trees(df)


# --- language ----------------------------------------------------------------------------------

@given(st.text(alphabet="abc", max_size=25))
def test_automaton_reads_substrings_only(text):
    follow = language_id.suffix_automaton([ord(c) for c in text])
    assert len(follow) <= max(1, 2 * len(text))
    subs = {text[a:b] for a in range(len(text)) for b in range(a, len(text) + 1)} | {""}

    def read(word):
        state = 0
        for c in word:
            state = follow[state].get(ord(c))
            if state is None:
                return False
        return True

    for word in subs | {s + c for s in subs for c in "abc"}:
        assert read(word) == (word in subs)


@settings(max_examples=40)
@given(st.lists(st.text(alphabet="abcdé. ", min_size=1, max_size=40), min_size=1, max_size=3), st.lists(st.text(alphabet="abcdéz. ", max_size=60), max_size=5))
def test_phrases_are_longest_matches(samples, texts):
    named = [(f"l{i}", s) for i, s in enumerate(samples)]
    parser = language_id.CrossParser(named)
    codes = [parser.alphabet.parse_form(parser.alphabet.encode(t.encode())) for t in texts]
    got = parser.phrases(codes)
    for k, (_, sample) in enumerate(named):
        known = bytes(parser.alphabet.parse_form(parser.alphabet.encode(sample.encode())).astype(np.uint8))
        for text, row in zip(codes, got, strict=True):
            left, n = bytes(text.astype(np.uint8)), 0
            while left:
                size = 0
                while size < len(left) and left[: size + 1] in known:
                    size += 1
                left, n = left[max(1, size) :], n + 1  # a character that the sample lacks is a phrase of its own
            assert row[k] == n


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_blocks_do_not_show(monkeypatch, block):
    pick = random.Random(block)
    samples = [("a", "abcabcabcabd" * 30), ("b", "xyz aé"), ("c", "".join(pick.choices("abc d", k=300)))]
    parser = language_id.CrossParser(samples)
    texts = [parser.alphabet.encode("".join(pick.choices("abcdéx ", k=k)).encode()) for k in (0, 1, 5, 40, 200, 333)]
    texts += [parser.alphabet.encode(("abc" * 150).encode()), parser.alphabet.encode(("abcabcabcabd" * 20).encode())]
    whole = parser.phrases(texts).tolist()
    monkeypatch.setattr(language_id, "BLOCK", block)
    assert parser.phrases(texts).tolist() == whole


def test_a_letter_that_a_language_lacks_costs_a_phrase():
    parser = language_id.CrossParser([("has", "a b é xa by"), ("lacks", "a b xa by")])
    codes = parser.alphabet.parse_form(parser.alphabet.encode("aéb".encode()))
    assert parser.phrases([codes]).tolist() == [[3, 3]]


def test_large_script_keeps_tables_small():
    pick = random.Random(3)
    script = "".join(pick.choices([chr(0x4E00 + i) for i in range(3000)], k=6000))
    samples = [("en", "".join(pick.choices("etaoin srhld", k=6000))), ("zh", script), ("zz", "")]
    tracemalloc.start()
    parser = language_id.CrossParser(samples)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # states x letters would be several 100 MB
    text = parser.alphabet.parse_form(parser.alphabet.encode((samples[0][1][50:90] + script[7:30] + "q" + script[3:300] + "tea" * 40).encode()))
    for (_, sample), found in zip(samples, parser.phrases([text])[0], strict=True):
        follow = language_id.suffix_automaton(parser.alphabet.parse_form(parser.alphabet.encode(sample.encode())).tolist())
        state = n = 0
        for c in text.tolist():
            if c not in follow[state]:
                state, n = 0, n + (state != 0)
            n += c not in follow[state]  # a letter that the sample lacks
            state = follow[state].get(c, 0)
        assert found == n + (state != 0)


@given(st.lists(st.text(alphabet="abcdefghijé日本", max_size=60), min_size=1, max_size=3), st.integers(15, 400))
@settings(max_examples=40, deadline=None)
def test_displaced_rows_hold_the_transitions(texts, width):
    for text in texts:
        follow = language_id.suffix_automaton(["abcdefghijé日本".index(c) + 1 for c in text])
        table, starts = language_id.displaced_rows(follow, width)
        assert len(set(starts.tolist())) == len(follow)
        for steps, at in zip(follow, starts.tolist(), strict=True):
            row = table[at : at + width]
            assert {c: int(row[c] & 0xFFFFFFFF) for c in range(width) if row[c] >> 32 == at} == {c: starts[t] for c, t in steps.items()}


def test_languages(spark):
    pick = random.Random(2)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "st", "ör"], "cc": ["qu", "è", "ch"]}

    def say(lang, n):
        return " ".join("".join(pick.choices(sounds[lang], k=3)) for _ in range(n))

    rows = [(i, say(lang := pick.choice(list(sounds)), pick.randint(3, 60)), lang) for i in range(150)]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 -- 34", "bb"), (903, "ka lo mi " * 5000, None), (904, "語", None), (905, "KALO MIKA LOMI", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, lang_pred string").repartition(4)
    samples = language_id.language_samples(docs.where(~held_out(docs["doc_id"])))
    assert [lang for lang, _ in samples] == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language_id.identify_languages(docs, samples).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i < 900)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 905)] == ["und", "und", "und", "aa", "aa"]
    assert got[904].lang_pred in sounds and all(0 <= r.score <= 1 for r in got.values())
    carried = language_id.identify_languages(docs, samples, carry=True)
    assert carried.columns == [*docs.columns, "predicted language", "its score"] and carried.count() == len(rows)
    assert language_id.identify_languages(docs.limit(0), samples).collect() == []
    assert {r.lang_pred for r in language_id.identify_languages(docs, []).collect()} == {"und"}


def test_samples_are_whole_texts_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LONG_TEXT", 50)
    rows = [(i, f"t{i} " + "w" * (i % 7), "few") for i in range(30)] + [(i, "x" * 400 + str(i), "long") for i in range(30, 33)] + [(40, "one", "rare")]
    docs = spark.createDataFrame([*rows, (50, "y" * 90, "few")], "doc_id long, text string, lang string").repartition(4)
    found = dict(language_id.language_samples(docs, rows=20, chars=60, languages=2))
    assert sorted(found) == ["few", "long"]
    assert found["long"] in {text for _, text, lang in rows if lang == "long"}
    taken = found["few"].split("\n")
    assert set(taken) <= {text for _, text, lang in rows if lang == "few"} and 60 <= sum(map(len, taken)) < 70


# --- tokens ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        return byte_bpe.ByteBPE(file.read(), PATTERN)


@pytest.fixture(scope="module")
def peer(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def check(coder, peer, texts):
    got = coder.encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [peer.encode_ordinary(t) for t in texts]
    assert coder.decode(got) == [t.encode() for t in texts]


def test_bpe_long_and_odd_texts(coder, peer):
    pick = random.Random(1)
    check(coder, peer, ["", " ", "<|endoftext|>", "a" * 20000, "ab" * 3000, "".join(pick.choices("abcdeé", k=3000)), "\x1c \x1c a", "x\u2028 y \u3000z",
                        "it's  'S'll \n\n\t z", "日本語" * 200, " " * 500, "x" * 64, "x" * 65, "😀👩‍👩‍👧"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé \n\t1.🙂\x1c", max_size=40), max_size=4))
def test_bpe(coder, peer, texts):
    check(coder, peer, texts)


def test_bpe_forgets_and_goes_on(coder, peer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORDS_KEPT", 3)
    monkeypatch.setattr(byte_bpe, "WORDS_AT_ONCE", 2)
    for text in ("some zzyqx words xqzzv here", "others qqzxy and zzyqx"):
        check(coder, peer, [text, text])


def test_bpe_with_any_ranks():
    """Ranks in which a merge comes before its parts': one pair a step, as the peer does."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"bc": 258, b"aa": 259, b"aaa": 260, b"abca": 261}
    file = b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items())
    own = byte_bpe.ByteBPE(file, r"\S+|\s+")
    peer = tiktoken.Encoding("odd", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    check(own, peer, ["aaaaaaa", "abcabcaab", "aabcbcaabca", "a" * 100, "abc" * 50, "xaab  bca"])


def test_unknown_ids_are_an_error(coder):
    with pytest.raises(ValueError, match="vocabulary"):
        coder.decode([np.array([50256], "<u4").tobytes()])


def test_bpe_tables(docs, texts, nothing, peer):
    got = bpe_digests(byte_bpe.decode_ids(byte_bpe.encode_texts(docs, RANKS, PATTERN), RANKS, PATTERN)).collect()
    want = Counter()
    for i, text in [*texts, texts[3]]:
        ids = peer.encode_ordinary(text or "")
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text or "")] += 1
    assert Counter(map(tuple, got)) == want
    assert Counter(map(tuple, bpe_digests(byte_bpe.encode_texts(docs, RANKS, PATTERN, decode=True)).collect())) == want
    then = byte_bpe.encode_texts(docs, RANKS, PATTERN, decode=True, then=(digests, DIGESTS.format("long")))
    assert Counter(map(tuple, then.collect())) == want
    assert byte_bpe.encode_texts(nothing, RANKS, PATTERN).collect() == []


# --- archives ----------------------------------------------------------------------------------

def warc_model(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        known = [x for x in groups[html or ""] if x is not None]
        newest = max(known) if len(groups[html or ""]) > 1 and len(payload) >= 1000 and known else None
        revisit = newest is not None and i != newest
        out[i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", newest if revisit else None] += 1
    return out


def pages(spark):
    pick = random.Random(9)
    noise = "".join(chr(pick.randrange(32, 0x2FFF)) for _ in range(60_000))
    rows = [(i, f"http://x.example/{i}", "é" * (480 + i)) for i in range(40)]
    rows += [(i, None, "é" * 510) for i in range(100, 130)] + [(200, "u", None), (201, "u\r\nX: y", ""), (202, "", "b" * 999), (203, "", "b" * 999)]
    rows += [(300 + i, "n", noise[i * 1000 : i * 1000 + 3000]) for i in range(50)] + [(None, "q", "é" * 510), (129, "again", "é" * 510)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)


def test_warc(spark, tmp_path):
    rows, df = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_warc(df, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "3000", "20000"):  # ranges smaller than a record, too
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != before else "4194304")
            assert Counter(map(tuple, warc.page_records(warc.read_warc(spark, path)).collect())) == warc_model(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_warc_reads_plain_gzip_members(spark, tmp_path):
    """Members of another writer, with the magic inside what they store, cut by ranges of any size."""
    import zlib

    records = []
    with open(tmp_path / "a.warc", "wb") as file:
        for i in range(60):
            body = b"x%d " % i + (b"\x1f\x8b\x08\x00junk" + bytes([i])) * (i % 7) + b"\x1f\x8b\x08"
            record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
            records.append(record)
            packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so the magic is there as it is
            file.write(packer.compress(record) + packer.flush())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("37", "101", "1000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = warc.read_warc(spark, str(tmp_path / "a.warc")).collect()
            assert Counter(bytes(r.record) for r in got) == Counter(records)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_unpacked_files_are_refused(spark, tmp_path):
    with gzip.open(tmp_path / "a.warc.gz", "wb") as file:
        file.write(b"WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    with pytest.raises(Exception, match="call it .warc"):
        warc.read_warc(spark, str(tmp_path / "a.warc.gz")).collect()


def test_member_ends_with_zero():
    for data in (b"", b"abc", b"x" * (2**24 + 5)):
        assert warc.gzip_member(data)[-1] == 0


def test_warc_of_nothing(spark, tmp_path):
    _, df = pages(spark)
    warc.write_warc(df.limit(0), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).collect() == []
