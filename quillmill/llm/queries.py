"""One query per operator, over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.llm.byte_bpe import decode_ids, encode_texts
from quillmill.llm.chat_format import as_threads, format_trees, read_back
from quillmill.llm.conversation_repair import conversation_key, repaired_conversations
from quillmill.llm.decontaminate import find_items, hit_words
from quillmill.llm.exact_dedup import exact_duplicates
from quillmill.llm.language_id import identify_languages, language_samples
from quillmill.llm.mixing import mix_sources
from quillmill.llm.near_dedup import near_duplicates
from quillmill.llm.substring_dedup import repeated_passages
from quillmill.llm.topk_search import top_k
from quillmill.llm.url_filter import judge_urls, page_links
from quillmill.llm.vector_clusters import cluster_vectors
from quillmill.llm.warc import archive_path, page_records, read_warc, write_warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
ODD_TURN = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TURN).alias("text"))
    return read_back(format_trees(as_threads(given.unionByName(odd)), best=1)).withColumnRenamed("tree", "conv_id")


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    found = identify_languages(docs, language_samples(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return judge_urls(pages, URL_RULES, page_links(pages, relative=True)).select("page_id", "host", "path", "rule", "verdict")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return encode_texts(docs, RANKS, PATTERN, decode=True, then=(digests, DIGESTS.format(dict(docs.dtypes)["doc_id"])))


DIGESTS = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of ids, and digests of the ids as 32-bit integers and of the decoded bytes."""
    for batch in batches:
        ids = batch.column("ids")
        flat, ends = ids.flatten().to_numpy().astype("<u4").tobytes(), np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())
        starts = np.append(0, ends[:-1]) if len(ends) else ends
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(ends - starts, pa.int64()),
            pa.array([hashlib.sha256(flat[4 * a : 4 * b]).hexdigest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.string()),
            pa.array([hashlib.sha256(one.as_buffer()).hexdigest() for one in batch.column("decoded")], pa.string()),
        ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def bpe_digests(decoded: DataFrame) -> DataFrame:
    """The same for a table of ids and decoded bytes."""
    return decoded.mapInArrow(digests, DIGESTS.format(dict(decoded.dtypes)["doc_id"]))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeated_passages(_table(spark, sf_dir, "documents"), digest=True)
    return cut.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = archive_path(spark)
    write_warc(_table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", hit_words(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def damaged(rows: DataFrame) -> DataFrame:
    """Messages with faults by a checksum of their place: dropped, emptied, without stops, repeated, or by the user."""
    space = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(place.cast("binary")) % 20
    given = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    left = given.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return left.drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    key = conversation_key(F.col("conv_id")).alias("key")
    found = repaired_conversations(damaged(given)).select(key, "*").drop("conv_id")
    every = given.select("conv_id").distinct().select(key, "conv_id").join(found, "key", "left").drop("key")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.na.fill(0, counts).na.fill({"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_chat_format, op2_language_id, op3_exact_dedup, op4_url_filter, op5_byte_bpe, op6_near_dedup,
             op7_substring_dedup, op8_warc, op9_mixing, op10_topk_search, op11_decontaminate, op12_conversation_repair,
             op13_centroid_clusters]
    return {query.__name__: query for query in found}


def _repair_sql() -> str:
    """Walks all conversations forwards, a row at a time, with the cheapest repair that ends in each of four states."""
    def best(*choices: str) -> str:
        return f"list_sort(list_filter([{', '.join(choices)}], lambda x: x IS NOT NULL))[1]"

    def step(state: str, price: str, edit: str, line: str | None) -> str:
        lines = f"list_append({state}.o, {line})" if line else f"{state}.o"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {price}, 'a': {state}.a || '{edit}', 'o': {lines}}} END"

    def inserted(q0: str, q1: str, q2: str, q3: str) -> tuple[str, str]:
        return best(q2, *[step(q, "3", "I", "'user:'") for q in (q0, q1, q3)]), step("s2", "3", "I", "'assistant:'")

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN left(r, 1) = '{initial}' AND NOT gone THEN {step(state, 'late', 'K', 'line')} END"

    def other(state: str, role: str) -> str:
        return f"CASE WHEN NOT gone THEN {step(state, '3 + late', 'R', chr(39) + role + chr(39) + ' || t')} END"

    drop = lambda state: step(state, "4", "D", None)
    u2, a3 = inserted("x0", "x1", "x2", "x3")
    return rf"""WITH RECURSIVE given AS (SELECT CASE WHEN conv_id IS NULL THEN '' ELSE '=' || conv_id END AS k, conv_id, turn,
          coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
        summed AS (SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(place, ''),
          lambda ch: list_transform(range(8), lambda b: CAST((ascii(ch) >> b) & 1 AS BIGINT))))),
          lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))) % 20 AS h FROM given),
        damaged AS (SELECT k, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS r,
          CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS t,
          unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM summed WHERE h <> 0),
        placed AS (SELECT k, turn, r, t, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, r, t) AS i,
          NOT regexp_matches(t, '[^ 	-
]') AS blank, NOT regexp_matches(t, '[.!?][ 	-
]*\z') AS late FROM damaged),
        faults AS (SELECT *, CASE WHEN blank THEN 'blank' WHEN row_number() OVER (PARTITION BY k, r, t ORDER BY i) > 1 THEN 'duplicate'
          WHEN late THEN 'truncated' ELSE '' END AS fault, left(lag(r) OVER (PARTITION BY k ORDER BY i), 1) || left(r, 1) AS pair FROM placed),
        counted AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
          count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
          count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY k),
        line AS (SELECT k, i, r, ':' || t AS t, r || ':' || t AS line, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS late FROM faults),
        walk AS (
          SELECT k, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s0,
            CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS s1, {{'c': CAST(3 AS BIGINT), 'a': 'I', 'o': ['user:']}} AS s2,
            {{'c': CAST(6 AS BIGINT), 'a': 'II', 'o': ['user:', 'assistant:']}} AS s3 FROM counted
          UNION ALL
          SELECT k, i, x0, x1, s2, {best('x3', a3)} FROM (SELECT *, {u2} AS s2 FROM (
            SELECT w.k, l.i, {drop('s0')} AS x0, {best(drop('s1'), kept('s0', 's'))} AS x1,
              {best(drop('s2'), *[kept(q, 'u') for q in ('s0', 's1', 's3')], *[other(q, 'user') for q in ('s0', 's1', 's3')])} AS x2,
              {best(drop('s3'), kept('s2', 'a'), other('s2', 'assistant'))} AS x3
            FROM walk AS w JOIN line AS l ON l.k = w.k AND l.i = w.i + 1))),
        done AS (SELECT counted.*, {best('s0', 's3')} AS e FROM counted JOIN walk ON walk.k = counted.k AND walk.i = counted.n)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit,
          sha256(coalesce(array_to_string(e.o, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT k, conv_id FROM given) LEFT JOIN done USING (k)"""


def _clusters_sql(rounds: int = 10, k: int = 8) -> str:
    """All rounds, one after the other."""
    square = "CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
          list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
          FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS MATERIALIZED (SELECT c, x FROM (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS INT) AS c, x FROM v) WHERE c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': {square}, 'c': c.c}}) AS n FROM v, c{i} AS c GROUP BY r)")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m, x) AS x FROM c{i} LEFT JOIN (
                SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
                  SELECT a.n.c AS c, i, sum(v.x[i]) AS s, count(*) AS n FROM a{i} AS a JOIN v USING (r), range(1, 65) AS t(i) GROUP BY ALL)
                GROUP BY c) USING (c))""")
    return "WITH " + ",\n".join(parts) + f""" SELECT vec_id, e.c AS cluster, CAST(a.n.d AS BIGINT) AS distance, CAST(sum(a.n.d) OVER (PARTITION BY e.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(a.n.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(e.x, ',')) AS centroid_sha256
        FROM a{rounds} AS a JOIN v USING (r) JOIN c{rounds} AS e ON e.c = a.n.c"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        # no page of the tables links to an alias that a rule blocks; tests cover those
        "op4_url_filter": r"""WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
            part AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
            rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
              ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
            ruled AS (SELECT page_id, host, path, (SELECT arg_max({'r': h || p, 'v': v}, length(h || p)) FROM rules
              WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS fit,
              regexp_replace(host, '^www\.([^.]+\.)', '\1') || regexp_replace(path, '/+$', '') AS named FROM part)
            SELECT page_id, host, path, fit.r AS rule, coalesce(fit.v, CASE WHEN named IN
              (SELECT named FROM ruled WHERE fit.v = 'block') THEN 'block' ELSE 'allow' END) AS verdict FROM ruled""",
        "op8_warc": """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
            g AS (SELECT page_id, payload, octet_length(payload) AS n, max(page_id) OVER (PARTITION BY payload) AS newest FROM p)
            SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest,
            CASE WHEN n >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN n >= 1000 AND page_id < newest THEN newest END AS refers_to FROM g""",
        "op10_topk_search": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
              WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
            SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *,
              row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
        "op11_decontaminate": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
            b AS (SELECT item_id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
            bp AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
            bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS x FROM bp),
            dp AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw)),
            hit AS (SELECT r, s, dp.n, item_id FROM dp JOIN bw ON bw.n = dp.n AND bw.x = array_to_string(list_slice(w, s, s + dp.n - 1), ' ')),
            words AS (SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS i FROM hit) GROUP BY r),
            items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
              sha256(coalesce(x, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
            FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
        "op12_conversation_repair": _repair_sql(),
        "op13_centroid_clusters": _clusters_sql(),
    }
