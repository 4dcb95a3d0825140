"""

The supplied tables hold no feeds, so entries and richer pages are derived from `pages` by
the SQL in `FEED_ENTRIES` and `PAGES_RICH`, which both engines run as it stands. Every query
covers the whole table.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillmill.functions import text
from quillmill.operators import documents as docs, entries as ops, nodes
from quillmill.operators.dedup import duplicate_posts, kept_posts
from quillmill.operators.markdown import html_to_markdown
from quillmill.operators.names import file_names, with_base_name
from quillmill.operators.rewrites import rewritten_nodes
from quillmill.operators.skew import spread
from quillmill.plans import ingest as job, report
from quillmill.session import ship
from quillmill.sources.discovery import FEED_NAMES, bare_path, discover_feeds, read_settings, with_base_url
from quillmill.sources.feeds import read_feeds, small_files, with_entry_index
from quillmill.sources.fingerprint import CHUNK_BYTES, compare_fingerprints, fingerprints
from quillmill.sources.sinks import clear_scratch, export_files, write_issues
from quillmill.staging import stage, stage_counted, staging_path

HERE = os.path.dirname(os.path.abspath(__file__))
try:  # these two may be taken out
    import corpus_pipeline
    from quillmill.llm import queries as llm
except ImportError:
    if all(os.path.exists(os.path.join(HERE, kept)) for kept in ("corpus_pipeline.py", "quillmill/llm/queries.py")):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
FEED = "archive/feed.atom"
FEED_SPAN = 64
BASE = "https://notes.blogspot.com"
LABEL_SCHEME = "http://www.blogger.com/atom/ns#"

FEED_ENTRIES = """
SELECT page_id + 1 AS entry_index,
  CASE WHEN page_id % 41 = 40 THEN '' ELSE concat('post-', CAST(CASE WHEN page_id % 13 = 12 THEN page_id - 6 ELSE page_id END AS STRING)) END AS id,
  CASE WHEN page_id % 37 = 36 THEN '' WHEN page_id % 5 = 0 THEN 'Weekly Notes' WHEN page_id % 5 = 1 THEN 'Weekly Notes 2' ELSE regexp_extract(html, '<title>(.*?)</title>', 1) END AS title,
  CASE WHEN page_id % 31 = 30 THEN NULL ELSE concat('2024-0', CAST(1 + page_id % 3 AS STRING), '-15T08:00:00Z') END AS published,
  CASE WHEN page_id % 31 = 30 AND page_id % 2 = 0 THEN '2023-12-31T00:00:00Z' END AS created,
  CASE WHEN page_id % 4 = 1 THEN concat('2024-06-', CAST(10 + page_id % 19 AS STRING), 'T00:00:00Z') END AS updated,
  CASE page_id % 11 WHEN 3 THEN 'PAGE' WHEN 5 THEN 'COMMENT' WHEN 7 THEN 'CUSTOM_WIDGET' WHEN 9 THEN NULL ELSE 'POST' END AS type,
  CASE WHEN page_id % 11 = 9 THEN concat('http://schemas.google.com/blogger/2008/kind#', CASE page_id % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'template' ELSE 'comment' END) END AS kind_term,
  CASE WHEN page_id % 33 = 9 THEN 'post-1' END AS reply_to,
  CASE page_id % 17 WHEN 4 THEN 'DRAFT' WHEN 8 THEN 'TRASHED' ELSE 'LIVE' END AS status,
  CASE WHEN page_id % 29 = 28 THEN 'yes' END AS draft,
  CASE WHEN page_id % 23 = 22 THEN '2024-05-01T00:00:00Z' WHEN page_id % 23 = 21 THEN 'false' END AS trashed,
  CASE WHEN page_id % 7 = 6 THEN NULL WHEN page_id % 19 = 18 THEN 'http://dup.example.com/x' ELSE url END AS alternate_url,
  CASE WHEN page_id % 21 = 13 THEN concat(url, '.atom') END AS other_url,
  CASE WHEN page_id % 7 = 6 AND page_id % 2 = 0 THEN concat('/2024/', CAST(page_id AS STRING), '.html') END AS filename,
  concat('Topic ', CAST(page_id % 4 AS STRING), ',notes,Topic ', CAST(page_id % 2 AS STRING), ',notes') AS labels_csv,
  CASE WHEN page_id % 3 = 0 THEN 'Ann Author' END AS author,
  html AS content
FROM pages
"""

PAGES_RICH = """
SELECT page_id, concat(html,
  CASE page_id % 3 WHEN 0 THEN concat('<table><tr><th colspan="', CAST(1 + page_id % 2 AS STRING), '">A</th><th>B</th></tr><tr><td>', CAST(page_id AS STRING), '</td><td>x</td></tr></table>') WHEN 1 THEN '<table><tr><td><ul><li>n</li></ul></td></tr></table>' ELSE '' END,
  CASE page_id % 4 WHEN 0 THEN concat('<pre class="brush: python"><code>x = ', CAST(page_id AS STRING), '</code></pre>') WHEN 1 THEN '<pre><code class="language-sql">select 1</code></pre>' WHEN 2 THEN '<pre>plain</pre>' ELSE '' END,
  CASE page_id % 5 WHEN 0 THEN concat('<iframe src="https://v.example.com/', CAST(page_id AS STRING), '"></iframe>') WHEN 1 THEN '<video src="/v.mp4"></video>' WHEN 2 THEN '<details><summary>s</summary>t</details>' ELSE '' END,
  CASE page_id % 6 WHEN 0 THEN concat('<table class="tr-caption-container"><tr><td><a href="/f', CAST(page_id AS STRING), '.png"><img src="/t.png" alt="c"/></a></td></tr><tr><td class="tr-caption">Cap ', CAST(page_id AS STRING), '</td></tr></table>') WHEN 1 THEN '<div class="separator"><a href="/b.png"><img src="/s.png"/></a></div>' WHEN 2 THEN '<div><br></div>' WHEN 3 THEN '<source-footnote></source-footnote>' ELSE '' END,
  CASE WHEN page_id % 7 = 0 THEN '<h3>Head<p>lifted one</p><p>lifted two</p></h3>' ELSE '' END,
  CASE WHEN page_id % 8 = 3 THEN concat('<ol start="', CAST(page_id AS STRING), '"><li>one</li><li>two</li></ol>') ELSE '' END) AS html
FROM pages
"""


# --- inputs derived from the tables ----------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> None:
    ship(spark)
    spark.read.parquet(f"{sf_dir}/pages.parquet").createOrReplaceTempView("pages")


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    return spark.sql(FEED_ENTRIES)


def pages_rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    return spread(spark.sql(PAGES_RICH))


def raw_elements(rows: DataFrame) -> DataFrame:
    """Feed entries as the nested elements a feed file holds."""
    null = "CAST(NULL AS STRING)"
    kind = f"named_struct('_scheme', 'http://schemas.google.com/g/2005#kind', '_term', kind_term, '_VALUE', {null})"
    label = f"t -> named_struct('_scheme', '{LABEL_SCHEME}', '_term', t, '_VALUE', {null})"

    def link(kind: str, href: str) -> str:
        return f"named_struct('_rel', 'alternate', '_type', '{kind}', '_href', {href}, '_VALUE', {null})"

    links = (
        f"filter(array({link('text/html', 'alternate_url')}, {link('application/atom+xml', 'other_url')}), "
        "l -> l._href IS NOT NULL)"
    )
    elements = {
        "id": "array(id)",
        "title": "array(named_struct('_VALUE', title, '_type', 'text'))",
        "content": "array(named_struct('_VALUE', content, '_type', 'html'))",
        **{tag: f"IF({tag} IS NULL, NULL, array({tag}))"
           for tag in ("type", "status", "published", "created", "updated", "trashed", "filename")},
        "category": f"concat(IF(kind_term IS NULL, array(), array({kind})), transform(split(labels_csv, ','), {label}))",
        "link": links,
        "author": f"IF(author IS NULL, NULL, array(named_struct('name', array(author), 'email', array({null}))))",
        "control": "IF(draft IS NULL, NULL, array(named_struct('draft', array(draft))))",
        "`in-reply-to`": f"IF(reply_to IS NULL, NULL, array(named_struct('_ref', reply_to, '_VALUE', {null})))",
        "inReplyTo": f"CAST(NULL AS ARRAY<STRING>)",
    }
    return rows.selectExpr("entry_index", *[f"{value} AS {tag}" for tag, value in elements.items()])


def parsed_entries(spark: SparkSession, sf_dir: str, *, content: bool = False) -> DataFrame:
    raw = raw_elements(feed_entries(spark, sf_dir)).withColumns(
        {"feed_path": F.lit(FEED), "base_url": F.lit(BASE), "row_id": F.col("entry_index")})
    return ops.parse_entries(raw if content else raw.drop("content"))


def written_feeds(spark: SparkSession, sf_dir: str) -> str:
    """The entries as feed files, `FEED_SPAN` consecutive ones each, by Spark's XML writer."""
    raw = raw_elements(feed_entries(spark, sf_dir)).withColumn("feed", F.expr(f"(entry_index - 1) DIV {FEED_SPAN}"))
    path = staging_path(spark, "feeds")
    (
        raw.repartitionByRange("feed").sortWithinPartitions("feed", "entry_index").drop("entry_index")
        .write.partitionBy("feed").format("xml").options(rowTag="entry", rootTag="feed", arrayElementName="item")
        .save(path)
    )
    return path


def write_files(files: DataFrame, root: str) -> None:
    """Write `text` to the file `name` below `root`, row by row."""
    place = F.concat(F.lit(f"{root}/"), "name").alias("file_path")
    nothing = F.lit(None).cast("string")
    rows = files.select(
        F.lit(FEED).alias("feed_path"), F.lit(0).cast("bigint").alias("entry_index"), nothing.alias("id"), nothing.alias("title"),
        place, F.col("text").alias("document"))
    failed = stage(export_files(rows, root), "exported").where("error IS NOT NULL").first()
    clear_scratch(root)
    if failed:
        raise OSError(failed.error)


def written_files(spark: SparkSession, sql: str) -> str:
    """The files that a query of names and texts gives, below a new folder."""
    root = bare_path(staging_path(spark, "files"))
    write_files(spark.sql(sql), root)
    return root


def hidden_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Feeds in which entry tags also stand where they are none, and tags in several orders."""
    _pages(spark, sf_dir)
    lines = spark.sql(HIDDEN_ENTRIES).selectExpr(f"(entry_index - 1) DIV {FEED_SPAN} AS feed", "entry_index AS at", "xml AS line")
    edges = lines.groupBy("feed").agg(F.min("at").alias("first"), F.max("at").alias("last")).select("feed", F.inline(F.array(
        F.struct((F.col("first") - 1).alias("at"), F.lit("<?xml version='1.0'?><feed><!-- <entry> -->").alias("line")),
        F.struct((F.col("last") + 1).alias("at"), F.lit("<!-- </entry> --></feed>").alias("line")))))
    path = staging_path(spark, "feeds")
    lines.unionByName(edges).repartitionByRange("feed").sortWithinPartitions("feed", "at").drop("at").write.partitionBy("feed").text(path)
    return path


def scanned_entries(raw: DataFrame) -> DataFrame:
    """Typed entries of a scan; the content is staged with the other elements, but numbered apart from them."""
    scanned, total = stage_counted(raw, "scanned")
    indexed = with_entry_index(scanned.drop("content"), total).withColumn("base_url", F.lit(BASE))
    content = scanned.select("row_id", ops.content_html().alias("content_html"))
    return ops.parse_entries(indexed).join(content, "row_id")


def feed_number(path: str) -> Column:
    return F.regexp_extract(path, "/feed=([0-9]+)/", 1).cast("bigint")


def decided_entries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, job.Decided, int]:
    entries, total = stage_counted(parsed_entries(spark, sf_dir), "entries")
    return entries, job.decide(entries, total), total


def extracted(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = getattr(nodes, name)(nodes.with_nodes(pages_rich(spark, sf_dir)), ["page_id"])
        return found.select("page_id", *columns)

    return query


# --- queries -----------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """What a feed holds: entries per route and kind, read from a written feed by the split reader."""
    scanned, total = stage_counted(read_feeds(spark, written_feeds(spark, SMOKE_DIR)).drop("content"), "scanned")
    indexed = with_entry_index(scanned, total).withColumn("base_url", F.lit(BASE))
    return (
        ops.parse_entries(indexed).groupBy("route", F.coalesce("skip_kind", "kind").alias("kind"))
        .agg(F.count("*").alias("entries"))
    )


def q_entry_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select(
        "entry_index", "id", "published", "updated", "author_name", "is_draft", "is_trashed")


def q_content_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir, content=True).select("entry_index", "content_html")


def q_entry_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", "kind")


def q_entry_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", "url")


def q_entry_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", F.array_join("labels", "|").alias("labels"))


def q_untitled_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", "title")


def q_date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", text.date_prefix(F.col("published")).alias("date_prefix"))


def q_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", text.slug(F.col("title")).alias("slug"))


def q_route_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.skipped(parsed_entries(spark, sf_dir)).drop("feed_path")


def q_route_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.skipped_breakdown(ops.skipped(parsed_entries(spark, sf_dir))).drop("feed_path")


def q_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.totals(parsed_entries(spark, sf_dir))


def q_entry_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.entry_issues(parsed_entries(spark, sf_dir)).drop("feed_path", "seq")


def q_feed_scan(splittable: bool) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return scanned_entries(read_feeds(spark, written_feeds(spark, sf_dir), splittable=splittable)).select(
            feed_number("feed_path").alias("feed"), "entry_index", "id", "title", "kind", "route",
            "published", "url", F.array_join("labels", "|").alias("labels"), "content_html")

    return query


def q_feed_scan_hidden(splittable: bool) -> Callable[[SparkSession, str], DataFrame]:
    """Feeds with entry tags in comments, CDATA sections and instructions, and with mixed content."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return scanned_entries(read_feeds(spark, hidden_feeds(spark, sf_dir), splittable=splittable)).select(
            feed_number("feed_path").alias("feed"), "entry_index", "id", "title", "content_html")

    return query


def q_tag_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned_entries(read_feeds(spark, hidden_feeds(spark, sf_dir))).select(
        feed_number("feed_path").alias("feed"), "entry_index", "published", "kind")


def q_settings_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base URLs of feeds in written archives: from the settings file beside each, or the one above."""
    _pages(spark, sf_dir)
    root = written_files(spark, """
        SELECT concat('blogs/b', page_id, '/feed.atom') AS name, '<feed/>' AS text FROM pages
        UNION ALL SELECT concat('blogs/b', page_id, '/settings.csv'), CASE page_id % 6
          WHEN 0 THEN concat('blog_name,blog_subdomain\n"A, ""b""\nc", b', page_id, ' \nother,other\n')
          WHEN 3 THEN concat('blog_subdomain,blog_name\r\n\r\nb', page_id, ',x\r\n')
          WHEN 1 THEN 'blog_name,blog_subdomain\nx,\n' ELSE 'blog_name\nx\n' END
        FROM pages WHERE page_id % 3 < 2
        UNION ALL SELECT 'blogs/settings.csv', 'blog_subdomain\nall' FROM pages WHERE page_id = 0""")
    with small_files(spark):
        feeds, number = stage_counted(discover_feeds(spark, root, 2).select("feed_path"), "feeds")
    found = with_base_url(feeds, read_settings(spark, root), number)
    return found.withColumn("feed_path", F.replace("feed_path", F.lit(f"{root}/"), F.lit("")))


def q_feed_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written archives whose folders have the characters of patterns in their names: their feeds, found and read."""
    _pages(spark, sf_dir)
    root = written_files(spark, """
        SELECT concat(name, inner) AS name, concat('<feed><entry><id>', name, inner, '</id></entry></feed>') AS text FROM (
          SELECT concat(CASE page_id DIV 5 % 4 WHEN 0 THEN 'Notes [2020]' WHEN 1 THEN 'My Blog é' WHEN 2 THEN '{a,b}*?' ELSE '100%20 +' END,
              ' ', page_id DIV 5, '/') AS name,
            CASE page_id % 7
              WHEN 0 THEN 'feed.atom' WHEN 1 THEN concat('Blogs/b', page_id, '/feed.atom')
              WHEN 2 THEN concat('Comments/', page_id, '.atom') WHEN 3 THEN concat('theme-', page_id, '.xml')
              WHEN 4 THEN concat('Blogs [x]/', page_id, '.xml') WHEN 5 THEN 'sub/atom.feed'
              ELSE concat('notes/', page_id, '.txt') END AS inner
          FROM pages)""")
    with small_files(spark):
        feeds = stage(discover_feeds(spark, root, 1), "feeds")
    short = lambda path: F.replace(path, F.lit(f"{root}/"), F.lit(""))
    read = read_feeds(spark, root, feeds, names=FEED_NAMES).select("feed_path", F.col("id")[0].alias("id"))
    return read.join(feeds, "feed_path").select(short("archive").alias("archive"), short("feed_path").alias("feed_path"), "id")


def q_content_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    return spark.table("pages").select("page_id", F.sha2("html", 256).alias("sha256"))


def q_input_unmodified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written files hashed before and after one of them has changed; the first one is larger than a task reads at once."""
    _pages(spark, sf_dir)
    files = spark.sql(f"""
        SELECT feed, concat('f', feed, '.atom') AS name, CASE feed WHEN 0 THEN repeat(text, {CHUNK_BYTES} DIV length(text) + 2) ELSE text END AS text
        FROM (SELECT page_id DIV {FEED_SPAN} AS feed, array_join(transform(array_sort(collect_list(struct(page_id, html))), p -> p.html), '') AS text
              FROM pages GROUP BY ALL)""")
    files = stage(files, "files")
    root = bare_path(staging_path(spark, "feeds"))
    write_files(files, root)
    before = stage(fingerprints(spark, root), "before")
    changed = F.concat(F.lit("x"), F.expr("substr(text, 2)"))
    write_files(files.where("feed = 1").withColumn("text", changed), root)
    compared = compare_fingerprints(before, stage(fingerprints(spark, root), "after"))
    return compared.join(before.select("feed_path", "size"), "feed_path").select(
        F.regexp_extract("feed_path", "/f([0-9]+)", 1).cast("bigint").alias("feed"), "size", "sha256", "unmodified")


def q_dedup_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = stage(parsed_entries(spark, sf_dir), "entries")
    return kept_posts(ops.published(entries)).select("entry_index", "id", "url")


def q_dedup_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided_entries(spark, sf_dir)[1].duplicates.drop("feed_path")


def q_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided_entries(spark, sf_dir)[1].kept.select("entry_index", "file_name")


def q_all_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for all entries, with more bases that end in numbers other bases hand out."""
    entries = parsed_entries(spark, sf_dir).withColumn(
        "title", F.expr("CASE entry_index % 6 WHEN 0 THEN 'Notes' WHEN 1 THEN 'Notes 2' WHEN 2 THEN 'Notes 3' "
                        "WHEN 3 THEN 'Notes' WHEN 4 THEN concat('Notes ', entry_index % 40) ELSE 'Notes 2 2' END"))
    return file_names(with_base_name(entries).select("feed_path", "entry_index", "base")).select("entry_index", "file_name")


def q_dedup_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that share their id with one neighbour and their URL with the other, in chains longer than the rounds go."""
    _pages(spark, sf_dir)
    return kept_posts(spark.sql(CHAINED_POSTS)).select("feed_path", "entry_index", "id", "url")


def q_name_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names where families of bases have more contests than one task settles."""
    _pages(spark, sf_dir)
    return file_names(spark.sql(NAME_FAMILIES), width=32, family_rows=2).select("feed_path", "entry_index", "file_name")


def q_document_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file a page, written twice as if a task had been lost, and read again; some have places that cannot be written to."""
    _pages(spark, sf_dir)
    root = written_files(spark, "SELECT 'blocked' AS name, CAST(count(*) AS STRING) AS text FROM pages")
    rows = spark.sql(f"""
        SELECT '{FEED}' AS feed_path, page_id AS entry_index, CAST(page_id AS STRING) AS id, 'T' AS title, html AS document,
          concat('{root}/', CASE WHEN page_id % 50 = 7 THEN 'blocked/' ELSE 'posts [é]/' END, page_id, '.md') AS file_path FROM pages""")
    for _ in range(2):
        failed = stage(write_issues(export_files(rows, root)), "failed")
    clear_scratch(root)
    files = spark.read.option("recursiveFileLookup", True).text(f"{root}/", wholetext=True).select(
        F.regexp_extract("_metadata.file_path", r"/([0-9]+)\.md$", 1).alias("name"), "value").where("name <> ''")
    written = files.select(F.col("name").cast("bigint").alias("page_id"), F.lit("written").alias("state"), F.col("value").alias("document"))
    return written.unionByName(failed.select(
        F.col("entry_index").alias("page_id"), F.col("issue_type").alias("state"), F.lit(None).cast("string").alias("document")))


def q_frontmatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_entries(spark, sf_dir).select("entry_index", docs.frontmatter_text().alias("frontmatter"))


def q_frontmatter_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.expr("map('type', kind, 'source', 'archive')")
    return parsed_entries(spark, sf_dir).select(
        "entry_index", docs.frontmatter_text("notes", extra).alias("frontmatter"))


def q_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.expr("CASE WHEN entry_index % 5 = 0 THEN ' ' ELSE concat(' # ', title, ' ') END")
    posts = parsed_entries(spark, sf_dir).withColumn("markdown", body)
    return docs.with_document(posts).select("entry_index", "document")


def q_md_postprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    source = spark.sql(POSTPROCESS_TEXT)
    return source.select("page_id", text.postprocess_markdown(F.col("source")).alias("markdown"))


def q_html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_to_markdown(pages_rich(spark, sf_dir), "html").select("page_id", "markdown", "error")


def q_markdown_of_known_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    return html_to_markdown(spark.sql(KNOWN_HTML), "html").select("page_id", "markdown", "error")


def q_markdown_of_known_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    return html_to_markdown(spark.sql(KNOWN_REPAIRS), "html").select("page_id", "markdown", "error")


def q_html_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.html_nodes(pages_rich(spark, sf_dir), ["page_id"]).select("page_id", "ord", "parent", "depth", "kind", "tag", "text")


def q_rewritten_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pages(spark, sf_dir)
    return rewritten_nodes(spark.sql(KNOWN_REPAIRS), ["page_id"]).select("page_id", "ord", "end_ord", "parent", "depth", "tag", "text")


def q_embeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.embeds(nodes.with_nodes(pages_rich(spark, sf_dir)), ["page_id"]).select("page_id", "tag", "outer_html")


def _report_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _counted_report_parts(spark, sf_dir)[0]


def _counted_report_parts(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], int]:
    """The tables of the report, and the number of entries."""
    entries, decided, total = decided_entries(spark, sf_dir)
    duplicates = stage(decided.duplicates, "duplicates")
    skipped = ops.skipped(entries)
    breakdown = report.skipped_breakdown(skipped)
    posts = ops.published(entries).join(decided.kept.select("feed_path", "entry_index", "file_name"), ["feed_path", "entry_index"])
    converted = docs.converted_records(posts, "output/posts")
    issues = report.all_issues(ops.entry_issues(entries), report.duplicate_issues(duplicates))
    feeds = entries.select("feed_path").distinct().selectExpr("feed_path", "CAST(NULL AS STRING) AS sha256", "true AS unmodified")
    summary = report.summary(
        feeds, entries, converted, duplicates, issues, breakdown, output_dir="output/posts", duration_seconds=0.0)
    return dict(summary=summary, breakdown=breakdown, duplicates=duplicates, issues=issues,
                converted=converted, skipped=skipped), total


def q_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_parts(spark, sf_dir)["converted"].drop("feed_path").withColumn("labels", F.array_join("labels", "|"))


def q_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_parts(spark, sf_dir)["issues"].drop("feed_path", "seq")


def q_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_parts(spark, sf_dir)["summary"].select(
        "input_file", "output_dir", "total_entries", "published_posts_found", "converted_count", "skipped_count",
        F.to_json("skipped_breakdown").alias("skipped_breakdown"), "duplicate_count", "issue_count", "duration_seconds")


def q_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _report_parts(spark, sf_dir)
    parts.pop("skipped")
    return report.markdown_lines(**parts).select("section", "sort", "entry_index", "line")


def q_json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, total = _counted_report_parts(spark, sf_dir)
    return report.json_lines(**parts, total=total * 6).select("section", "sort", "entry_index", "seq", "line")


def _ingested(spark: SparkSession, sf_dir: str) -> job.Ingested:
    return job.ingest(
        spark, written_feeds(spark, sf_dir), "output/posts", depth=1, base_url=BASE, dry_run=True)


def q_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over written feeds: counts per feed."""
    return _ingested(spark, sf_dir).summary.select(
        feed_number("input_file").alias("feed"), "total_entries", "published_posts_found", "converted_count",
        "skipped_count", "duplicate_count", "issue_count", "input_file_unmodified")


def q_ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over written feeds: the frontmatter of every document (its body is checked elsewhere)."""
    front = F.regexp_extract("document", r"(?s)\A(---\n.*?\n---\n)", 1)
    return _ingested(spark, sf_dir).documents.select(
        feed_number("feed_path").alias("feed"), "entry_index", "file_name", front.alias("frontmatter"))


# Inputs that both engines derive by the same SQL.
HIDDEN_ENTRIES = """
SELECT page_id + 1 AS entry_index, concat('<entry><id>h-', CAST(page_id AS STRING), '</id>',
  CASE page_id % 6 WHEN 0 THEN '<!-- </entry><entry> <![CDATA[ -->' WHEN 1 THEN '<?note </entry> <!-- ?>' WHEN 2 THEN '<x><entry a=">"/></x>' ELSE '' END,
  CASE page_id % 4 WHEN 0 THEN '<created>2023-01-01T00:00:00Z</created><published></published>'
    WHEN 1 THEN '<published/><created>2023-01-01T00:00:00Z</created>'
    WHEN 2 THEN '<created>2023-01-01T00:00:00Z</created><published>2024-01-01T00:00:00Z</published>'
    ELSE '<published>2024-01-01T00:00:00Z</published><created>2023-01-01T00:00:00Z</created>' END,
  CASE page_id % 5 WHEN 0 THEN '<in-reply-to ref="x"/><category scheme="#kind" term="k#post"/>'
    WHEN 1 THEN '<category scheme="#kind" term="k#post"/><in-reply-to ref="x"/>' WHEN 2 THEN '<category scheme="#kind" term="k#page"/><inReplyTo>x</inReplyTo>'
    WHEN 3 THEN '<in-reply-to ref="x"/><type>TEMPLATE</type>' ELSE '' END,
  '<title><![CDATA[</entry> ', CAST(page_id AS STRING), ']]></title>',
  CASE WHEN page_id % 7 = 3 THEN concat('<content type="xhtml">lead ', CAST(page_id AS STRING), ' <!-- </entry> --><div><published>no</published></div> tail</content>')
    ELSE concat('<content type="html"><![CDATA[', replace(html, ']]>', ''), '<entry>', CAST(page_id AS STRING), '</entry> -->]]></content>') END,
  '</entry>') AS xml, replace(html, ']]>', '') AS html, page_id
FROM pages
"""
POSTPROCESS_TEXT = """
SELECT page_id, concat('  \n\n', CAST(page_id AS STRING), ' &amp;amp; &lt;b&gt; &copy;', chr(160), 'x   \r\n   \t \r\n\n\n\n',
  replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&', ''), '  ', chr(10), 'end &#65;&nbsp;', chr(13), 'z  ', chr(10), '```sql', chr(10), 'a &lt; b', chr(10), '```', chr(10), 'last &lt;', chr(10), '```', chr(10), '&copy;') AS source
FROM pages
"""
KNOWN_HTML = """
SELECT page_id, concat('<h2>Part ', CAST(page_id AS STRING), '</h2><p>', t, ' <b>bold ', CAST(page_id % 9 AS STRING),
  '</b> and <a href="/p/', CAST(page_id AS STRING), '">link</a>.</p><ul><li>one</li><li>two</li></ul><blockquote><p>', u,
  '</p></blockquote><pre class="brush: sql">select ', CAST(page_id AS STRING), '</pre><table><tr><th>A</th><th>B</th></tr><tr><td>',
  CAST(page_id AS STRING), '</td><td>x</td></tr></table><div><br></div><p>H<sub>2</sub>O</p><!-- gone -->') AS html
FROM (SELECT page_id, concat('Text ', trim(regexp_extract(html, '<title>([A-Za-z ]+)', 1))) AS t,
  concat('u', CAST(page_id * 7 AS STRING)) AS u FROM pages) AS known
"""
# Chains of 40 posts; in every third one a post has no URL, which cuts it.
CHAINED_POSTS = """
SELECT concat('f', CAST(page_id % 3 AS STRING)) AS feed_path, page_id + 1 AS entry_index, concat('c', CAST(chain AS STRING), '-', CAST(CAST(floor((k + 1) / 2) AS BIGINT) AS STRING)) AS id,
  CASE WHEN chain % 3 = 2 AND k = 20 THEN '' ELSE concat('u', CAST(chain AS STRING), '-', CAST(CAST(floor(k / 2) AS BIGINT) AS STRING)) END AS url
FROM (SELECT page_id, page_id % 3 + 3 * CAST(floor(page_id / 120) AS BIGINT) AS chain, CAST(floor(page_id / 3) AS BIGINT) % 40 AS k FROM pages) AS placed
"""
NAME_FAMILIES = """
SELECT concat('f', CAST(page_id % 2 AS STRING)) AS feed_path, page_id + 1 AS entry_index, concat('2024-01-0', CAST(1 + CAST(floor(page_id / 150) AS BIGINT) % 2 AS STRING), CASE page_id % 7
  WHEN 0 THEN '-notes' WHEN 1 THEN concat('-notes-', CAST(2 + page_id % 9 AS STRING)) WHEN 2 THEN '-notes-2' WHEN 3 THEN concat('-notes-2-', CAST(2 + page_id % 4 AS STRING))
  WHEN 4 THEN '-log' WHEN 5 THEN concat('-log-', CAST(page_id % 5 AS STRING)) ELSE concat('-notes-3-2-', CAST(1 + page_id % 3 AS STRING)) END) AS base
FROM pages
"""
# Each page's title with a snippet that the editor leaves behind; the repaired nodes and the Markdown of each are below.
KNOWN_REPAIRS = """
SELECT page_id, concat('<p>', t, '</p>', CASE page_id % 8
  WHEN 0 THEN concat('<h3>T', p, '<p>1</p><ul><li><p>2</p></li></ul></h3>z')
  WHEN 1 THEN concat('<table class="x tr-caption-container"><tr><td><a href="/f"><img src="/t', p, '"></a></td></tr><tr><td class="tr-caption"> A <b>b</b> </td></tr></table>')
  WHEN 2 THEN concat('a<div class="separator"><a href="/b', p, '"><img src="/s"></a></div>b')
  WHEN 3 THEN concat('a<source-footnote> </source-footnote><response-element>b', p, ' <i>c</i></response-element>')
  WHEN 4 THEN concat('<!-- gone --><table border=1><tr><td colspan="2">a', p, '</td></tr></table>')
  WHEN 5 THEN concat('<div><br /></div><p>&nbsp;</p><div><div><br></div></div><div>', p, '</div>')
  WHEN 6 THEN concat('<html><head><script>x</script></head><div>a<video src="/v', p, '"><p>v</p></video>b<pre class="brush: sql">c</pre></div>d')
  ELSE concat('<ol start="3"><li>b', p, '</li><li>c<ul><li>d</li></ul></li></ol><hr><del>x</del> <code>k</code> m<sup>2</sup>') END) AS html
FROM (SELECT page_id, CAST(page_id AS STRING) AS p, regexp_extract(html, '<title>(.*?)</title>', 1) AS t FROM pages) AS titled
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _queries() | ({"pipeline": corpus_pipeline.run, **llm.queries()} if llm else {})


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "entry_fields": q_entry_fields,
        "content_html": q_content_html,
        "entry_kind": q_entry_kind,
        "entry_url": q_entry_url,
        "entry_labels": q_entry_labels,
        "untitled_fallback": q_untitled_fallback,
        "date_prefix": q_date_prefix,
        "slugs": q_slugs,
        "feed_scan": q_feed_scan(False),
        "feed_scan_split": q_feed_scan(True),
        "feed_scan_hidden": q_feed_scan_hidden(True),
        "feed_scan_hidden_whole": q_feed_scan_hidden(False),
        "tag_order": q_tag_order,
        "feed_discovery": q_feed_discovery,
        "settings_join": q_settings_join,
        "content_sha": q_content_sha,
        "input_unmodified": q_input_unmodified,
        "route_rows": q_route_rows,
        "route_breakdown": q_route_breakdown,
        "totals": q_totals,
        "entry_issues": q_entry_issues,
        "dedup_kept": q_dedup_kept,
        "dedup_duplicates": q_dedup_duplicates,
        "file_names": q_file_names,
        "all_file_names": q_all_file_names,
        "dedup_chains": q_dedup_chains,
        "name_families": q_name_families,
        "html_nodes": q_html_nodes,
        "links": extracted("links", "href", "text"),
        "images": extracted("images", "src", "alt", "href"),
        "headings": extracted("headings", "level", "text"),
        "captions": extracted("captions", "src", "href", "alt", "caption"),
        "complex_tables": extracted("complex_tables", "cells", "is_complex"),
        "pipe_tables": extracted("pipe_tables", "line"),
        "code_blocks": extracted("code_blocks", "language", "code"),
        "lifted_blocks": extracted("lifted_blocks", "tag", "place"),
        "spacers": extracted("spacers", "tag"),
        "separators": extracted("separators"),
        "widgets": extracted("widgets", "tag", "action"),
        "list_items": extracted("list_items", "bullet", "text"),
        "embeds": q_embeds,
        "html_to_markdown": q_html_to_markdown,
        "markdown_of_known_html": q_markdown_of_known_html,
        "markdown_of_known_repairs": q_markdown_of_known_repairs,
        "rewritten_nodes": q_rewritten_nodes,
        "md_postprocess": q_md_postprocess,
        "frontmatter": q_frontmatter,
        "frontmatter_extra": q_frontmatter_extra,
        "documents": q_documents,
        "document_export": q_document_export,
        "converted": q_converted,
        "issues": q_issues,
        "summary_counts": q_summary_counts,
        "report_lines": q_report_lines,
        "json_report": q_json_report,
        "ingest_summary": q_ingest_summary,
        "ingest_documents": q_ingest_documents,
    }


# --- the same in SQL -----------------------------------------------------------------------------

_SLUG = r"""CASE WHEN {dashed} = '' THEN 'post' ELSE regexp_replace(left({dashed}, 60), '-+$', '') END"""
_DASHED = (
    r"regexp_replace(lower(trim(regexp_replace(regexp_replace(strip_accents({t}), '[^\x00-\x7F]', '', 'g'), "
    r"'[^\w\s-]', '', 'g'))), '[-\s]+', '-', 'g')"
)


def _slug_sql(title: str) -> str:
    return _SLUG.format(dashed=_DASHED.format(t=title))


def _walk_names(name: str, source: str) -> str:
    """CTEs that hand out names one row of `source` (g, feed, base) after the other."""
    return f"""
{name}_line AS (SELECT row_number() OVER (ORDER BY g) AS rn, g, feed || '/' || base AS base FROM {source}),
{name}_walk AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS g, CAST(NULL AS VARCHAR) AS file_name, CAST([] AS VARCHAR[]) AS used
  UNION ALL
  SELECT rn, g, file_name, list_append(used, file_name) FROM (
    SELECT l.rn, l.g, w.used,
      CASE WHEN NOT list_contains(w.used, l.base || '.md') THEN l.base || '.md'
           ELSE list_filter(list_transform(range(2, l.rn + 2), lambda n: l.base || '-' || CAST(n AS VARCHAR) || '.md'),
                            lambda f: NOT list_contains(w.used, f))[1] END AS file_name
    FROM {name}_walk w JOIN {name}_line l ON l.rn = w.rn + 1)),
{name} AS (SELECT g, regexp_replace(file_name, '^[0-9]+/', '') AS file_name FROM {name}_walk WHERE rn > 0)"""


def _ctes(span: int) -> str:
    """Entries and all decisions on them, for feeds of `span` entries; `g` is the place over all feeds."""
    return f"""WITH RECURSIVE fe AS ({FEED_ENTRIES}),
e1 AS (
  SELECT entry_index AS g, (entry_index - 1) // {span} AS feed, (entry_index - 1) % {span} + 1 AS entry_index,
    trim(id) AS raw_id, trim(title) AS raw_title, coalesce(published, created, '') AS published,
    updated, author AS author_name, content AS content_html,
    coalesce(alternate_url, '{BASE}' || filename, other_url) AS url,
    list_filter(string_split(labels_csv, ','), lambda x, i: list_position(string_split(labels_csv, ','), x) = i) AS labels,
    status = 'DRAFT' OR coalesce(draft = 'yes', false) AS is_draft,
    status = 'TRASHED' OR coalesce(trashed NOT IN ('false', '0', 'none'), false) AS is_trashed,
    CASE WHEN type IS NOT NULL THEN lower(type)
         WHEN kind_term LIKE '%#comment' THEN 'comment' WHEN kind_term LIKE '%#template' THEN 'template'
         WHEN reply_to IS NOT NULL THEN 'comment' ELSE 'post' END AS kind
  FROM fe),
e AS (
  SELECT *, CASE WHEN raw_id = '' THEN 'generated:entry-' || entry_index ELSE raw_id END AS id,
    CASE WHEN raw_title <> '' THEN raw_title WHEN kind = 'post' THEN 'Untitled Post ' || entry_index
         ELSE 'Untitled ' || upper(left(kind, 1)) || substr(kind, 2) || ' ' || entry_index END AS title,
    CASE WHEN is_trashed THEN 'trashed' WHEN kind <> 'post' THEN kind WHEN is_draft THEN 'draft' END AS skip_kind,
    CASE WHEN is_trashed THEN 'Skipped trashed/deleted entry'
         WHEN kind <> 'post' THEN 'Skipped non-post entry kind: ''' || kind || ''''
         WHEN is_draft THEN 'Skipped draft post (not published)' END AS skip_reason,
    CASE WHEN published = '' THEN 'undated' ELSE left(published, 10) END AS date_prefix
  FROM e1),
ei AS (
  SELECT feed, entry_index, 'warning' AS severity, 'unfamiliar_entry_type' AS issue_type, raw_id AS post_id, raw_title AS post_title,
    'Encountered unfamiliar entry type ''' || kind || ''' at index ' || entry_index || '.' AS message
  FROM e WHERE kind NOT IN ('post', 'comment', 'page', 'template', 'settings')
  UNION ALL SELECT feed, entry_index, 'warning', 'missing_id', id, raw_title,
    'Entry at index ' || entry_index || ' is missing an <id> tag. Assigned fallback: ' || id FROM e WHERE raw_id = ''
  UNION ALL SELECT feed, entry_index, 'warning', 'missing_title', id, title,
    'Post ''' || id || ''' has no title. Assigned fallback: ''' || title || '''' FROM e WHERE kind = 'post' AND raw_title = ''
  UNION ALL SELECT feed, entry_index, 'warning', 'missing_publication_date', id, title,
    'Post ''' || title || ''' (' || id || ') is missing a published date.' FROM e WHERE kind = 'post' AND published = ''
  UNION ALL SELECT feed, entry_index, 'warning', 'missing_url', id, title,
    'Published post ''' || title || ''' (' || id || ') does not have an alternate html URL link or filename.'
  FROM e WHERE kind = 'post' AND NOT is_draft AND NOT is_trashed AND url IS NULL),
posts AS (
  SELECT row_number() OVER (ORDER BY g) AS rn, g, feed || '/' || id AS id, feed || '/' || url AS url
  FROM e WHERE skip_kind IS NULL),
walk AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS g, false AS stays, CAST([] AS VARCHAR[]) AS ids, CAST([] AS VARCHAR[]) AS urls
  UNION ALL
  SELECT rn, g, stays, CASE WHEN stays THEN list_append(ids, id) ELSE ids END,
    CASE WHEN stays AND url IS NOT NULL THEN list_append(urls, url) ELSE urls END
  FROM (SELECT p.rn, p.g, p.id, p.url, w.ids, w.urls,
          NOT list_contains(w.ids, p.id) AND NOT coalesce(list_contains(w.urls, p.url), false) AS stays
        FROM walk w JOIN posts p ON p.rn = w.rn + 1)),
kept AS (SELECT e.* FROM e JOIN walk USING (g) WHERE stays),
kept_base AS (SELECT g, feed, date_prefix || '-' || {_slug_sql('title')} AS base FROM kept),{_walk_names('names', 'kept_base')},
named AS (SELECT kept.*, file_name FROM kept JOIN names USING (g)),
dups AS (
  SELECT d.feed, d.entry_index, d.id AS post_id, d.title, d.url,
    CASE WHEN i.file_name IS NOT NULL THEN 'Duplicate post ID encountered: ''' || d.id || ''' (already seen as ''' || i.file_name || ''')'
         ELSE 'Duplicate canonical URL encountered: ''' || d.url || ''' (already seen as ''' || u.file_name || ''')' END AS reason,
    coalesce(i.file_name, u.file_name) AS first_seen_file
  FROM e d LEFT JOIN named i ON i.feed = d.feed AND i.id = d.id AND i.g < d.g
    LEFT JOIN named u ON u.feed = d.feed AND u.url = d.url AND u.g < d.g
  WHERE d.skip_kind IS NULL AND d.g NOT IN (SELECT g FROM kept)),
iss AS (
  SELECT * FROM ei
  UNION ALL SELECT feed, entry_index, 'warning', 'duplicate_post', post_id, title, reason FROM dups),
brk AS (SELECT skip_kind AS kind, count(*) AS count FROM e WHERE skip_kind IS NOT NULL GROUP BY 1),
total AS (
  SELECT feed, total_entries, published_posts_found, coalesce(converted_count, 0) AS converted_count, skipped_count,
    coalesce(duplicate_count, 0) AS duplicate_count, coalesce(issue_count, 0) AS issue_count
  FROM (SELECT feed, count(*) AS total_entries, count(*) FILTER (skip_kind IS NULL) AS published_posts_found,
          count(*) FILTER (skip_kind IS NOT NULL) AS skipped_count FROM e GROUP BY feed)
    LEFT JOIN (SELECT feed, count(*) AS converted_count FROM named GROUP BY feed) USING (feed)
    LEFT JOIN (SELECT feed, count(*) AS duplicate_count FROM dups GROUP BY feed) USING (feed)
    LEFT JOIN (SELECT feed, count(*) AS issue_count FROM iss GROUP BY feed) USING (feed))
"""


_CTES = _ctes(2**40)
_FEEDS = _ctes(FEED_SPAN)
_RICH = f"WITH rich AS ({PAGES_RICH})\n"
_TABLES = _RICH.rstrip() + r""",
tables AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<table.*?</table>')) AS t FROM rich),
judged AS (SELECT page_id, t, len(regexp_extract_all(t, '<t[dh][ >]')) AS cells,
  regexp_matches(t, 'colspan="([2-9]|1\d)') OR regexp_matches(t, '<(ul|ol|pre|blockquote)') AS is_complex FROM tables)
"""
_FRONT = """'---' || chr(10) || 'title: ' || to_json(title) || chr(10) || 'date: ' || to_json(published) || chr(10) ||
  'url: ' || to_json(coalesce(url, '')) || chr(10) ||
  'labels:' || array_to_string(list_transform(labels, lambda x: chr(10) || '- ' || to_json(x)), '') || chr(10) ||
  'classification: {kind}' || chr(10) || 'type: ' || {type} || chr(10) || 'id: ' || to_json(id) ||
  CASE WHEN coalesce(updated, '') <> '' THEN chr(10) || 'updated: ' || to_json(updated) ELSE '' END ||
  CASE WHEN coalesce(author_name, '') <> '' THEN chr(10) || 'author: ' || to_json(author_name) ELSE '' END"""
_PLAIN = """'"personal_analysis"'"""
_TEXT = r"trim(regexp_replace({x}, '<[^>]*>', '', 'g'))"


def _nodes_sql() -> str:
    """Reads pages tag by tag, with the open tags as state."""
    kinds = "STRUCT(ord INT, parent INT, depth INT, kind VARCHAR, tag VARCHAR, text VARCHAR)[]"
    void = "('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr')"
    node = "{{'ord': n, 'parent': coalesce(ords[-1], -1), 'depth': CAST(len(ords) + 1 AS INT), 'kind': {}, 'tag': {}, 'text': {}}}"
    inner = "{'ord': CAST(n + 1 AS INT), 'parent': n, 'depth': CAST(len(ords) + 2 AS INT), 'kind': 'raw', 'tag': '', 'text': regexp_extract(t, '(?s)^<[^>]*>(.*)</', 1)}"
    decoded = "t"
    for name, char in (("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&quot;", "chr(34)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&amp;", "'&'")):
        decoded = f"replace({decoded}, '{name}', {char})"
    return _RICH.rstrip().replace("WITH rich", "WITH RECURSIVE rich") + rf""",
cut AS (SELECT page_id, regexp_extract_all(html, '(?s)<!--.*?-->|<![^>]*>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|</?[a-zA-Z][^>]*>|[^<]+') AS x FROM rich),
tok AS (SELECT page_id, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS t FROM cut),
read AS (SELECT page_id, i, t, lower(regexp_extract(t, '^</?([a-zA-Z][a-zA-Z0-9-]*)', 1)) AS tag, CASE WHEN starts_with(t, '<!--') THEN 'comment'
  WHEN starts_with(t, '<!') THEN 'doctype' WHEN regexp_matches(t, '^<(script|style)') THEN 'raw' WHEN starts_with(t, '</') THEN 'close'
  WHEN starts_with(t, '<') THEN 'open' ELSE 'text' END AS k FROM tok),
walk AS (
  SELECT page_id, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS tags, CAST([] AS INT[]) AS ords, CAST(0 AS INT) AS n, CAST([] AS {kinds}) AS nodes FROM cut
  UNION ALL
  SELECT page_id, i, CASE WHEN grows THEN list_append(tags, tag) WHEN up IS NOT NULL THEN tags[1:len(tags) - up] ELSE tags END,
    CASE WHEN grows THEN list_append(ords, n) WHEN up IS NOT NULL THEN ords[1:len(ords) - up] ELSE ords END,
    CAST(n + CASE k WHEN 'raw' THEN 2 WHEN 'close' THEN 0 ELSE 1 END AS INT),
    CASE k WHEN 'close' THEN [] WHEN 'raw' THEN [{node.format("'element'", "tag", "''")}, {inner}] WHEN 'open' THEN [{node.format("'element'", "tag", "''")}]
      WHEN 'text' THEN [{node.format("'text'", "''", decoded)}] WHEN 'comment' THEN [{node.format("'comment'", "''", "t[5:len(t) - 3]")}]
      ELSE [{node.format("'doctype'", "''", "trim(t[10:len(t) - 1])")}] END
  FROM (SELECT r.*, w.tags, w.ords, w.n, k = 'open' AND tag NOT IN {void} AND NOT ends_with(t, '/>') AS grows,
      CASE WHEN k = 'close' THEN list_position(list_reverse(tags), tag) END AS up
    FROM walk AS w JOIN read AS r ON r.page_id = w.page_id AND r.i = w.i + 1))
SELECT page_id, o.ord AS ord, o.parent AS parent, o.depth AS depth, o.kind AS kind, o.tag AS tag, o.text AS text
FROM (SELECT page_id, unnest(nodes) AS o FROM walk)"""


# Nodes of the repaired snippets of KNOWN_REPAIRS, which follow the title's two: (snippet, ord, end_ord, parent, depth, tag, text).
REPAIRED = """
(0, 2, 3, -1, 1, 'h3', ''), (0, 3, 3, 2, 2, '', 'T#'), (0, 4, 5, -1, 1, 'p', ''), (0, 5, 5, 4, 2, '', '2'), (0, 6, 7, -1, 1, 'ul', ''),
(0, 7, 7, 6, 2, 'li', ''), (0, 8, 9, -1, 1, 'p', ''), (0, 9, 9, 8, 2, '', '1'), (0, 10, 10, -1, 1, '', 'z'),
(1, 2, 7, -1, 1, 'div', ''), (1, 3, 4, 2, 2, 'a', ''), (1, 4, 4, 3, 3, 'img', ''), (1, 5, 7, 2, 2, 'p', ''), (1, 6, 7, 5, 3, 'em', ''), (1, 7, 7, 6, 4, '', 'Ab'),
(2, 2, 2, -1, 1, '', 'a'), (2, 3, 4, -1, 1, 'a', ''), (2, 4, 4, 3, 2, 'img', ''), (2, 5, 5, -1, 1, '', 'b'),
(3, 2, 2, -1, 1, '', 'ab# '), (3, 3, 4, -1, 1, 'i', ''), (3, 4, 4, 3, 2, '', 'c'),
(4, 2, 5, -1, 1, 'table', ''), (4, 3, 5, 2, 2, 'tr', ''), (4, 4, 5, 3, 3, 'td', ''), (4, 5, 5, 4, 4, '', 'a#'),
(5, 2, 2, -1, 1, 'div', ''), (5, 3, 4, -1, 1, 'div', ''), (5, 4, 4, 3, 2, '', '#'),
(6, 2, 14, -1, 1, 'html', ''), (6, 3, 5, 2, 2, 'head', ''), (6, 4, 5, 3, 3, 'script', ''), (6, 5, 5, 4, 4, '', 'x'), (6, 6, 13, 2, 2, 'div', ''),
(6, 7, 7, 6, 3, '', 'a'), (6, 8, 10, 6, 3, 'video', ''), (6, 9, 10, 8, 4, 'p', ''), (6, 10, 10, 9, 5, '', 'v'), (6, 11, 11, 6, 3, '', 'b'),
(6, 12, 13, 6, 3, 'pre', ''), (6, 13, 13, 12, 4, '', 'c'), (6, 14, 14, 2, 2, '', 'd'),
(7, 2, 9, -1, 1, 'ol', ''), (7, 3, 4, 2, 2, 'li', ''), (7, 4, 4, 3, 3, '', 'b#'), (7, 5, 9, 2, 2, 'li', ''), (7, 6, 6, 5, 3, '', 'c'), (7, 7, 9, 5, 3, 'ul', ''),
(7, 8, 9, 7, 4, 'li', ''), (7, 9, 9, 8, 5, '', 'd'), (7, 10, 10, -1, 1, 'hr', ''), (7, 11, 12, -1, 1, 'del', ''), (7, 12, 12, 11, 2, '', 'x'),
(7, 13, 13, -1, 1, '', ' '), (7, 14, 15, -1, 1, 'code', ''), (7, 15, 15, 14, 2, '', 'k'), (7, 16, 16, -1, 1, '', ' m'), (7, 17, 18, -1, 1, 'sup', ''),
(7, 18, 18, 17, 2, '', '2')"""
REPAIRED_MARKDOWN = r"""CASE page_id % 8 WHEN 0 THEN '### T#~~2~~1~~z' WHEN 1 THEN '[![Ab](/t#)](/f)~~*Ab*' WHEN 2 THEN 'a[![](/s)](/b#)b'
  WHEN 3 THEN 'ab# *c*' WHEN 4 THEN '<table border="1"><tr><td colspan="2">a#</td></tr></table>' WHEN 5 THEN '#'
  WHEN 6 THEN 'a~~<video src="/v#"><p>v</p></video>~~b~~```sql~c~```~~d' ELSE '3. b#~4. c~   - d~~---~~^x^ `k` m<sup>2</sup>' END"""


def _bar(c: str) -> str:
    return f"replace({c}, '|', chr(92) || '|')"


def _lines_sql() -> str:
    def fixed(section: int, lines: list[str], condition: str = "true") -> str:
        texts = ", ".join("'" + line.replace("'", "''") + "'" if not line.startswith("=") else line[1:] for line in lines)
        return (f"SELECT {section} AS section, '' AS sort, CAST(0 AS BIGINT) AS entry_index, unnest([{texts}]) AS line "
                f"FROM total WHERE {condition}")

    def table(section: int, title: str, columns: list[str], condition: str = "true") -> list[str]:
        return [fixed(section, [title, "", "| " + " | ".join(columns) + " |", "| " + " | ".join([":---"] * len(columns)) + " |"], condition),
                fixed(section + 2, [""], condition)]

    metrics = [("Total Feed Entries", "total_entries"), ("Published Posts Found", "published_posts_found"),
               ("Successfully Converted", "converted_count"), ("Skipped Entries", "skipped_count"),
               ("Duplicate Entries", "duplicate_count"), ("Conversion Issues / Warnings", "issue_count")]
    parts = [
        fixed(0, ["# Blogger / Blogspot Ingestion Report", "", f"**Input File:** `{FEED}`", "**Output Directory:** `output/posts`",
                  "**Execution Duration:** 0.00s", "**Original Archive Unmodified:** ✅ Yes", "", "## Summary Metrics", "",
                  "| Metric | Count |", "| :--- | :--- |", *[f"='| **{t}** | ' || {c} || ' |'" for t, c in metrics], ""]),
        *table(10, "### Skipped Entries Breakdown", ["Category", "Count"], "skipped_count > 0"),
        "SELECT 11, kind, 0, '| ' || upper(left(kind, 1)) || substr(kind, 2) || ' | ' || count || ' |' FROM brk",
        *table(20, "## Duplicates Detected", ["Title", "Post ID", "Reason"], "duplicate_count > 0"),
        f"SELECT 21, '', entry_index, '| ' || {_bar('title')} || ' | `' || post_id || '` | ' || reason || ' |' FROM dups",
        *table(30, "## Conversion Issues & Warnings", ["Severity", "Issue Type", "Post / Title", "Details"], "issue_count > 0"),
        "SELECT 31, '', entry_index, '| ' || upper(severity) || ' | `' || issue_type || '` | ' || "
        f"{_bar('coalesce(nullif(post_title, {0}), nullif(post_id, {0}), {1})'.format(chr(39) * 2, chr(39) + 'N/A' + chr(39)))} "
        f"|| ' | ' || {_bar('message')} || ' |' FROM iss",
        *table(40, "## Converted Posts", ["Date", "Title", "Output File", "Labels"]),
        f"SELECT 41, '', entry_index, '| ' || left(published, 10) || ' | ' || {_bar('title')} || ' | `' || file_name || '` | ' || "
        "array_to_string(labels, ', ') || ' |' FROM named",
    ]
    return _CTES + "\nUNION ALL ".join(parts)


def _json_sql() -> str:
    def fixed(section: int, *lines: str) -> str:
        texts = ", ".join(line[1:] if line.startswith("=") else f"'{line}'" for line in lines)
        return (f"SELECT {section} AS section, '' AS sort, CAST(0 AS BIGINT) AS entry_index, "
                f"CAST(unnest(range({len(lines)})) AS INT) AS seq, unnest([{texts}]) AS line FROM total")

    def elements(section: int, source: str, fields: dict[str, str], seq: str = "0") -> str:
        pairs = ", ".join(f"'{name}', {value}" for name, value in fields.items())
        return (f"SELECT {section}, '', entry_index, CAST({seq} AS INT), CASE WHEN row_number() OVER (ORDER BY entry_index, {seq}) = 1 "
                f"THEN '     ' ELSE '    ,' END || json_object({pairs}) FROM {source}")

    numbers = ["total_entries", "published_posts_found", "converted_count", "skipped_count", "duplicate_count", "issue_count"]
    same = lambda *names: {name: name for name in names}
    order = ["unfamiliar_entry_type", "missing_id", "missing_title", "missing_publication_date", "missing_url"]
    # Issues are numbered in the order an entry's are found; a duplicate comes after them.
    seq = f"""CASE WHEN issue_type = 'duplicate_post' THEN 100 ELSE row_number() OVER (
        PARTITION BY entry_index ORDER BY list_position({order}, issue_type)) - 1 END"""
    parts = [
        fixed(0, "{", '  "summary": {', f'    "input_file": "{FEED}",', '    "output_dir": "output/posts",',
              '    "input_file_hash_sha256": null,', '    "input_file_unmodified": true,',
              *[f"""='    "{n}": ' || {n} || ','""" for n in numbers], '    "duration_seconds": 0.0,', '    "skipped_breakdown": {'),
        """SELECT 10, kind, 0, 0, CASE WHEN row_number() OVER (ORDER BY kind) = 1 THEN '     ' ELSE '    ,' END
           || to_json(kind) || ': ' || count FROM brk""",
        fixed(11, "    }", "  },"),
        fixed(20, '  "converted_posts": ['), fixed(22, "  ],"),
        elements(21, "named", {"post_id": "id", "title": "title", "date": "published", "url": "url", "labels": "labels",
                               "file_path": "'output/posts/' || file_name", "file_name": "file_name",
                               "classification": "'personal_analysis'"}),
        fixed(30, '  "skipped_entries": ['), fixed(32, "  ],"),
        elements(31, "(SELECT * FROM e WHERE skip_kind IS NOT NULL)",
                 {"post_id": "id", "title": "title", "kind": "skip_kind", "reason": "skip_reason"}),
        fixed(40, '  "duplicates": ['), fixed(42, "  ],"),
        elements(41, "dups", same("post_id", "title", "url", "reason", "first_seen_file")),
        fixed(50, '  "issues": ['), fixed(52, "  ]"),
        elements(51, f"(SELECT *, {seq} AS seq FROM iss)", same("severity", "issue_type", "post_id", "post_title", "message"), "seq"),
        fixed(60, "}"),
    ]
    return _CTES + "\nUNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | (llm.oracle_sql() if llm else {})


def _oracle_sql() -> dict[str, str]:
    every = lambda pattern, group: f"unnest(regexp_extract_all(html, '{pattern}', {group}))"
    link = '(?s)<a href="([^"]*)">(.*?)</a>'
    image = '(?:<a href="([^"]*)">)?<img src="([^"]*)"(?: alt="([^"]*)")?/>'
    heading = "(?s)<h([1-6])>(.*?)</h[1-6]>"
    scan = _FEEDS + """SELECT feed, entry_index, id, title, kind, CASE WHEN skip_kind IS NULL THEN 'published' ELSE 'skipped' END AS route,
        published, url, array_to_string(labels, '|') AS labels, content_html FROM e"""
    hidden = f"""WITH h AS ({HIDDEN_ENTRIES}), f AS (SELECT *, (entry_index - 1) // {FEED_SPAN} AS feed, (entry_index - 1) % {FEED_SPAN} + 1 AS place FROM h)
        SELECT feed, place AS entry_index, """
    hidden_content = hidden + """'h-' || page_id AS id, '</entry> ' || page_id AS title,
        CASE WHEN page_id % 7 = 3 THEN 'lead ' || page_id || ' ' ELSE html || '<entry>' || page_id || '</entry> -->' END AS content_html FROM f"""
    notes = "CASE entry_index % 6 WHEN 0 THEN 'notes' WHEN 1 THEN 'notes-2' WHEN 2 THEN 'notes-3' WHEN 3 THEN 'notes' " \
            "WHEN 4 THEN 'notes-' || entry_index % 40 ELSE 'notes-2-2' END"
    return {
        "entry_fields": _CTES + "SELECT entry_index, id, published, updated, author_name, is_draft, is_trashed FROM e",
        "content_html": f"WITH fe AS ({FEED_ENTRIES}) SELECT entry_index, content AS content_html FROM fe",
        "entry_kind": _CTES + "SELECT entry_index, kind FROM e",
        "entry_url": _CTES + "SELECT entry_index, url FROM e",
        "entry_labels": _CTES + "SELECT entry_index, array_to_string(labels, '|') AS labels FROM e",
        "untitled_fallback": _CTES + "SELECT entry_index, title FROM e",
        "date_prefix": _CTES + "SELECT entry_index, date_prefix FROM e",
        "slugs": _CTES + f"SELECT entry_index, {_slug_sql('title')} AS slug FROM e",
        "feed_scan": scan,
        "feed_scan_split": scan,
        "feed_scan_hidden": hidden_content,
        "feed_scan_hidden_whole": hidden_content,
        "tag_order": hidden + """CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN '2023-01-01T00:00:00Z' ELSE '2024-01-01T00:00:00Z' END AS published,
            CASE page_id % 5 WHEN 1 THEN 'comment' WHEN 2 THEN 'page' WHEN 3 THEN 'template' ELSE 'post' END AS kind FROM f""",
        "feed_discovery": """
            WITH files AS (SELECT page_id // 5 AS a, page_id, page_id % 7 AS m FROM pages),
            named AS (SELECT a, CASE m WHEN 0 THEN 'feed.atom' WHEN 1 THEN 'Blogs/b' || page_id || '/feed.atom'
                WHEN 2 THEN 'Comments/' || page_id || '.atom' WHEN 3 THEN 'theme-' || page_id || '.xml'
                WHEN 4 THEN 'Blogs [x]/' || page_id || '.xml' ELSE 'sub/atom.feed' END AS f,
                CASE m WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 5 THEN 3 WHEN 2 THEN 4 ELSE 5 END AS p,
                m IN (2, 3) AS skipped FROM files WHERE m < 6),
            best AS (SELECT CASE a % 4 WHEN 0 THEN 'Notes [2020]' WHEN 1 THEN 'My Blog é' WHEN 2 THEN '{a,b}*?' ELSE '100%20 +' END || ' ' || a AS archive, f
              FROM named QUALIFY row_number() OVER (PARTITION BY a ORDER BY p, skipped, f) = 1)
            SELECT archive, archive || '/' || f AS feed_path, archive || '/' || f AS id FROM best""",
        "settings_join": """SELECT 'blogs/b' || page_id || '/feed.atom' AS feed_path,
            CASE page_id % 3 WHEN 0 THEN 'https://b' || page_id || '.blogspot.com' WHEN 2 THEN 'https://all.blogspot.com' END AS base_url
            FROM pages""",
        "input_unmodified": f"""WITH f AS (SELECT page_id // {FEED_SPAN} AS feed, string_agg(html, '' ORDER BY page_id) AS t FROM pages GROUP BY ALL),
            w AS (SELECT feed, CASE feed WHEN 0 THEN repeat(t, {CHUNK_BYTES} // length(t) + 2) ELSE t END AS t FROM f)
            SELECT feed, CAST(octet_length(encode(t)) AS BIGINT) AS size, sha256(t) AS sha256, feed <> 1 AS unmodified FROM w""",
        "content_sha": "SELECT page_id, sha256(html) AS sha256 FROM pages",
        "route_rows": _CTES + """SELECT entry_index, id AS post_id, title, skip_kind AS kind, skip_reason AS reason
            FROM e WHERE skip_kind IS NOT NULL""",
        "route_breakdown": _CTES + "SELECT kind, count FROM brk",
        "totals": _CTES + f"""SELECT f AS feed_path, total_entries, published_posts_found, skipped_count
            FROM total, (VALUES ('{FEED}'), (NULL)) AS feeds(f)""",
        "entry_issues": _CTES + "SELECT * EXCLUDE (feed) FROM ei",
        "dedup_kept": _CTES + "SELECT entry_index, id, url FROM kept",
        "dedup_duplicates": _CTES + "SELECT * EXCLUDE (feed) FROM dups",
        "file_names": _CTES + "SELECT entry_index, file_name FROM named",
        "all_file_names": _CTES.rstrip() + f""",
            free AS (SELECT g, feed, date_prefix || '-' || {notes} AS base FROM e),{_walk_names('freed', 'free')}
            SELECT g AS entry_index, file_name FROM freed""",
        "html_nodes": _nodes_sql(),
        "rewritten_nodes": f"""WITH r(c, ord, end_ord, parent, depth, tag, text) AS (VALUES {REPAIRED}), t AS (SELECT page_id,
              replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&quot;', chr(34)), '&amp;', '&') AS t FROM pages)
            SELECT page_id, ord, end_ord, parent, depth, tag, replace(text, '#', CAST(page_id AS VARCHAR)) AS text FROM pages JOIN r ON c = page_id % 8
            UNION ALL SELECT page_id, 0, 1, -1, 1, 'p', '' FROM t UNION ALL SELECT page_id, 1, 1, 0, 2, '', t FROM t""",
        "markdown_of_known_repairs": f"""SELECT page_id, trim(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&quot;', chr(34)), '&amp;', '&'))
              || chr(10) || chr(10) || replace(replace(replace(replace(replace({REPAIRED_MARKDOWN}, '###', '@@@'), '#', CAST(page_id AS VARCHAR)), '@@@', '###'), '~', chr(10)), '^', '~~') AS markdown,
            CAST(NULL AS VARCHAR) AS error FROM pages""",
        "links": _RICH + f"SELECT page_id, {every(link, 1)} AS href, regexp_replace({every(link, 2)}, '<[^>]*>', '', 'g') AS text FROM rich",
        "images": _RICH + f"""SELECT page_id, {every(image, 2)} AS src, coalesce({every(image, 3)}, '') AS alt,
            nullif({every(image, 1)}, '') AS href FROM rich""",
        "headings": _RICH + rf"""SELECT page_id, CAST(level AS INT) AS level,
            replace({_TEXT.format(x="x")}, '&amp;', '&') AS text
            FROM (SELECT page_id, {every(heading, 1)} AS level, {every(heading, 2)} AS x FROM rich)""",
        "captions": _RICH + """SELECT page_id, '/t.png' AS src, '/f' || page_id || '.png' AS href, 'c' AS alt,
            regexp_extract(html, '"tr-caption">(.*?)<', 1) AS caption FROM rich WHERE contains(html, 'tr-caption-container')""",
        "complex_tables": _TABLES + "SELECT page_id, CAST(cells AS INT) AS cells, is_complex FROM judged",
        "pipe_tables": _TABLES + rf"""SELECT page_id, '| ' || array_to_string(list_transform(
            regexp_extract_all(r, '(?s)<t[dh][^>]*>(.*?)</t[dh]>', 1), lambda x: {_TEXT.format(x="x")}), ' | ') || ' |' AS line
            FROM (SELECT page_id, unnest(regexp_extract_all(t, '(?s)<tr>(.*?)</tr>', 1)) AS r FROM judged WHERE NOT is_complex)""",
        "code_blocks": _RICH + r"""SELECT page_id, CASE WHEN contains(x, 'brush: python') THEN 'python'
            WHEN contains(x, 'language-sql') THEN 'sql' ELSE '' END AS language, regexp_replace(x, '<[^>]*>', '', 'g') AS code
            FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<pre.*?</pre>')) AS x FROM rich)""",
        "lifted_blocks": """SELECT page_id, 'p' AS tag, CAST(unnest([2, 1]) AS INT) AS place FROM pages WHERE page_id % 7 = 0""",
        "spacers": _RICH + "SELECT page_id, 'div' AS tag FROM rich WHERE contains(html, '<div><br></div>')",
        "separators": _RICH + "SELECT page_id FROM rich WHERE contains(html, '<div class=\"separator\">')",
        "widgets": _RICH + """SELECT page_id, 'source-footnote' AS tag, 'drop' AS action FROM rich
            WHERE contains(html, '<source-footnote></source-footnote>')""",
        "list_items": _RICH + rf"""SELECT page_id, '-' AS bullet, {_TEXT.format(x="x")} AS text FROM (SELECT page_id,
              unnest(regexp_extract_all(regexp_replace(html, '<ol.*?</ol>', '', 'g'), '(?s)<li>(.*?)</li>', 1)) AS x FROM rich)
            UNION ALL SELECT page_id, (page_id + n) || '.', w FROM (SELECT page_id, unnest([0, 1]) AS n, unnest(['one', 'two']) AS w
              FROM rich WHERE contains(html, '<ol'))""",
        "embeds": _RICH + r"""SELECT page_id, regexp_extract(x, '<(\w+)', 1) AS tag, x AS outer_html FROM (SELECT page_id,
            unnest(regexp_extract_all(html, '(?s)<(?:iframe|video|details).*?</(?:iframe|video|details)>')) AS x FROM rich)""",
        "markdown_of_known_html": f"WITH k AS ({KNOWN_HTML})" + r""" SELECT page_id, array_to_string(['## Part ' || page_id, '',
            trim(regexp_extract(html, '<p>(.*?)<b>', 1)) || ' **bold ' || page_id % 9 || '** and [link](/p/' || page_id || ').', '',
            '- one', '- two', '', '> u' || page_id * 7, '', '```sql', 'select ' || page_id, '```', '',
            '| A | B |', '| --- | --- |', '| ' || page_id || ' | x |', '', 'H<sub>2</sub>O'], chr(10)) AS markdown,
            CAST(NULL AS VARCHAR) AS error FROM k""",
        "md_postprocess": f"WITH s AS ({POSTPROCESS_TEXT})" + r""" SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(
            replace(replace(replace(replace(replace(replace(replace(replace(replace(source, 'a &lt; b', 'a @lt; b'), '&lt;', '<'), '&gt;', '>'), '&copy;', chr(169)),
              '&#65;', 'A'), '&nbsp;', ' '), '&amp;', '&'), '@lt;', '&lt;'), chr(160), ' '),
            '\r\n?', chr(10), 'g'), '(?m)[ \t]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), chr(10) || ' ') AS markdown FROM s""",
        "dedup_chains": f"""WITH RECURSIVE p AS ({CHAINED_POSTS}),
            line AS (SELECT *, row_number() OVER (ORDER BY entry_index) AS rn FROM p),
            walk AS (SELECT CAST(0 AS BIGINT) AS rn, false AS stays, CAST([] AS VARCHAR[]) AS keys
              UNION ALL SELECT rn, stays, CASE WHEN stays THEN list_concat(keys, mine) ELSE keys END FROM (
                SELECT l.rn, w.keys, l.mine, NOT list_has_any(w.keys, l.mine) AS stays FROM walk AS w JOIN (SELECT rn,
                  CASE WHEN url = '' THEN [feed_path || '/i' || id] ELSE [feed_path || '/i' || id, feed_path || '/u' || url] END AS mine FROM line) AS l ON l.rn = w.rn + 1))
            SELECT feed_path, entry_index, id, nullif(url, '') AS url FROM line JOIN walk USING (rn) WHERE stays""",
        "name_families": f"""WITH RECURSIVE p AS ({NAME_FAMILIES}), given AS (SELECT entry_index AS g, right(feed_path, 1) AS feed, base FROM p),{_walk_names('named', 'given')}
            SELECT feed_path, entry_index, file_name FROM p JOIN named ON named.g = p.entry_index""",
        "document_export": """SELECT page_id, CASE WHEN page_id % 50 = 7 THEN 'file_write_error' ELSE 'written' END AS state,
            CASE WHEN page_id % 50 <> 7 THEN html END AS document FROM pages""",
        "frontmatter": _CTES + "SELECT entry_index, " + _FRONT.format(kind='"personal_analysis"', type=_PLAIN)
            + " || chr(10) || '---' || chr(10) AS frontmatter FROM e",
        "frontmatter_extra": _CTES + "SELECT entry_index, " + _FRONT.format(kind='"notes"', type="to_json(kind)")
            + """ || chr(10) || '"source": "archive"' || chr(10) || '---' || chr(10) AS frontmatter FROM e""",
        "documents": _CTES + "SELECT entry_index, " + _FRONT.format(kind='"personal_analysis"', type=_PLAIN)
            + """ || chr(10) || '---' || chr(10) || chr(10) ||
            CASE WHEN entry_index % 5 = 0 THEN '' ELSE '# ' || title || chr(10) END AS document FROM e""",
        "converted": _CTES + """SELECT entry_index, id AS post_id, title, published AS date, url, array_to_string(labels, '|') AS labels,
            'output/posts/' || file_name AS file_path, file_name, 'personal_analysis' AS classification FROM named""",
        "issues": _CTES + "SELECT * EXCLUDE (feed) FROM iss",
        "summary_counts": _CTES + f"""SELECT '{FEED}' AS input_file, 'output/posts' AS output_dir, total_entries,
            published_posts_found, converted_count, skipped_count,
            (SELECT '{{' || string_agg('"' || kind || '":' || count, ',' ORDER BY kind) || '}}' FROM brk) AS skipped_breakdown,
            duplicate_count, issue_count, CAST(0 AS DOUBLE) AS duration_seconds FROM total""",
        "report_lines": _lines_sql(),
        "json_report": _json_sql(),
        "ingest_summary": _FEEDS + "SELECT *, true AS input_file_unmodified FROM total",
        "ingest_documents": _FEEDS + "SELECT feed, entry_index, file_name, "
            + _FRONT.format(kind='"personal_analysis"', type=_PLAIN) + " || chr(10) || '---' || chr(10) AS frontmatter FROM named",
    }
