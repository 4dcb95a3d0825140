"""Entry fields: raw feed elements -> typed columns, issues and route, all as expressions.

Where the order of different tags matters, `tags` has it, and the tags are folded in that order. Rows without
`tags` are read as if `published` came before `created`, and reply marks after all categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions.text import blank_to_null, capitalized, strip

# Fixed values of the archive format.
KIND_SCHEME = "http://schemas.google.com/g/2005#kind"
KIND_MARK = "#kind"
SCHEMA_PREFIX = "http://schemas.google.com/"
CATEGORY_KINDS = ["comment", "page", "template", "settings", "post"]
KNOWN_KINDS = ["post", "comment", "page", "template", "settings"]
DRAFT_YES = ["yes", "true", "1"]
TRASHED_NO = ["false", "0", "none"]
REPLY_TAGS = ["in-reply-to", "inReplyTo"]
# Fixed texts of the report format; %1$s kind, %2$s id, %3$s title, %4$s index.
UNFAMILIAR_TYPE = "Encountered unfamiliar entry type '%1$s' at index %4$s."
MISSING_ID = "Entry at index %4$s is missing an <id> tag. Assigned fallback: %2$s"
MISSING_TITLE = "Post '%2$s' has no title. Assigned fallback: '%3$s'"
MISSING_DATE = "Post '%3$s' (%2$s) is missing a published date."
MISSING_URL = "Published post '%3$s' (%2$s) does not have an alternate html URL link or filename."
SKIPPED_TRASHED = "Skipped trashed/deleted entry"
SKIPPED_DRAFT = "Skipped draft post (not published)"
SKIPPED_KIND = "Skipped non-post entry kind: '%s'"


def _texts(tag: str, field: str | None = None) -> Column:
    """Stripped text of every `tag` child, in document order; absent tag -> empty array."""
    tags = F.coalesce(F.col(f"`{tag}`"), F.array())
    return F.transform(tags, lambda t: strip(F.coalesce(t[field] if field else t, F.lit(""))))


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def _first(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def _nonblank(values: Column) -> Column:
    return F.filter(values, lambda v: v != "")


def _terms() -> Column:
    """Categories with a non-blank term, the term stripped."""
    categories = F.coalesce(F.col("category"), F.array())
    stripped = F.transform(
        categories,
        lambda c: F.struct(
            F.coalesce(c["_scheme"], F.lit("")).alias("scheme"),
            strip(F.coalesce(c["_term"], F.lit(""))).alias("term"),
        ),
    )
    return F.filter(stripped, lambda c: c["term"] != "")


def _is_kind(category: Column) -> Column:
    return (category["scheme"] == KIND_SCHEME) | category["scheme"].contains(KIND_MARK)


def _category_kind(term: Column) -> Column:
    kind = F.when(term.contains(f"#{CATEGORY_KINDS[0]}"), CATEGORY_KINDS[0])
    for name in CATEGORY_KINDS[1:]:
        kind = kind.when(term.contains(f"#{name}"), name)
    return kind.otherwise(F.element_at(F.split(term, "#"), -1))


def labels() -> Column:
    plain = F.filter(_terms(), lambda c: ~_is_kind(c) & ~c["term"].startswith(SCHEMA_PREFIX))
    return F.array_distinct(F.transform(plain, lambda c: c["term"]))


def kind(tags: Column | None = None) -> Column:
    """The explicit type, else what the categories and reply marks say, in the order of `tags`."""
    explicit = F.lower(_last(_nonblank(_texts("type"))))
    found = F.transform(F.coalesce(F.col("category"), F.array()), lambda c: F.struct(
        F.coalesce(c["_scheme"], F.lit("")).alias("scheme"), strip(F.coalesce(c["_term"], F.lit(""))).alias("term")))
    kinds = F.transform(found, lambda c: F.when(_is_kind(c) & (c["term"] != ""), _category_kind(c["term"])))
    replies = F.col("`in-reply-to`").isNotNull() | F.col("inReplyTo").isNotNull()
    last = F.coalesce(_last(F.filter(kinds, lambda k: k.isNotNull())), F.lit("post"))
    implied = F.when(replies & (last == "post"), "comment").otherwise(last)
    if tags is None:
        return F.coalesce(explicit, implied)

    def step(state: Column, tag: Column) -> Column:
        after_category = F.struct(
            F.coalesce(F.get(kinds, state["seen"]), state["kind"]).alias("kind"), (state["seen"] + 1).alias("seen"))
        after_reply = F.struct(
            F.when(state["kind"] == "post", "comment").otherwise(state["kind"]).alias("kind"), state["seen"].alias("seen"))
        return F.when(tag == "category", after_category).when(tag.isin(*REPLY_TAGS), after_reply).otherwise(state)

    start = F.struct(F.lit("post").alias("kind"), F.lit(0).alias("seen"))
    return F.coalesce(explicit, F.aggregate(tags, start, step, lambda state: state["kind"]), implied)


def published_text(tags: Column | None = None) -> Column:
    """`published`; `created` counts where nothing has been published before it."""
    published, created = _texts("published"), _texts("created")
    either = F.coalesce(blank_to_null(_last(published)), _first(_nonblank(created)), F.lit(""))
    if tags is None:
        return either

    def step(state: Column, tag: Column) -> Column:
        text = F.when(tag == "published", F.get(published, state["published"]))
        text = text.when((tag == "created") & (state["text"] == ""), F.get(created, state["created"])).otherwise(state["text"])
        return F.struct(
            text.alias("text"), (state["published"] + (tag == "published").cast("int")).alias("published"),
            (state["created"] + (tag == "created").cast("int")).alias("created"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("published"), F.lit(0).alias("created"))
    return F.coalesce(F.aggregate(tags, start, step, lambda state: state["text"]), either)


def url(base_url: Column) -> Column:
    """Alternate HTML link, else the path joined to the blog's base, else any other alternate."""
    links = F.transform(
        F.coalesce(F.col("link"), F.array()),
        lambda l: F.struct(
            (F.coalesce(l["_type"], F.lit("")) == "text/html").alias("html"),
            (F.coalesce(l["_rel"], F.lit("")) == "alternate").alias("alternate"),
            strip(F.coalesce(l["_href"], F.lit(""))).alias("href"),
        ),
    )
    alternates = F.filter(links, lambda l: l["alternate"] & (l["href"] != ""))
    canonical = _last(F.filter(alternates, lambda l: l["html"]))["href"]
    other = _first(F.filter(alternates, lambda l: ~l["html"]))["href"]
    path = _last(F.filter(_texts("filename"), lambda p: p.startswith("/")))
    base = F.regexp_replace(blank_to_null(base_url), r"/+\z", "")
    return F.coalesce(canonical, F.concat(base, path), path, other)


def is_draft() -> Column:
    drafts = F.flatten(F.transform(
        F.coalesce(F.col("control"), F.array()),
        lambda c: F.coalesce(c["draft"], F.array(F.lit(None).cast("string"))),
    ))
    return (
        F.exists(_texts("status"), lambda s: F.upper(s) == "DRAFT")
        | F.exists(drafts, lambda d: F.lower(strip(F.coalesce(d, F.lit("")))).isin(DRAFT_YES))
    )


def is_trashed() -> Column:
    return (
        F.exists(_texts("status"), lambda s: F.upper(s) == "TRASHED")
        | F.exists(_nonblank(_texts("trashed")), lambda t: ~F.lower(t).isin(TRASHED_NO))
    )


def content_html() -> Column:
    """Content as it stands, not stripped."""
    texts = F.transform(F.coalesce(F.col("content"), F.array()), lambda c: F.coalesce(c["_VALUE"], F.lit("")))
    return F.coalesce(_last(texts), F.lit(""))


def parse_entries(raw: DataFrame) -> DataFrame:
    """Typed entries from raw ones that carry `feed_path`, `entry_index` and `base_url`.

    Adds `issues` (array, in emission order) and the routing columns `route`, `skip_kind`
    and `skip_reason`.
    """
    authors = F.coalesce(F.col("author"), F.array())
    tags = F.col("tags") if "tags" in raw.columns else None

    def author(field: str) -> Column:
        values = F.flatten(F.transform(authors, lambda a: F.coalesce(a[field], F.array().cast("array<string>"))))
        return F.when(F.size(values) > 0, strip(F.coalesce(_last(values), F.lit(""))))

    fields = raw.select(
        *[c for c in ("feed_path", "row_id", "entry_index") if c in raw.columns],
        F.coalesce(_last(_texts("id")), F.lit("")).alias("raw_id"),
        F.coalesce(_last(_texts("title", "_VALUE")), F.lit("")).alias("raw_title"),
        published_text(tags).alias("published"),
        _last(_texts("updated")).alias("updated"),
        url(F.col("base_url")).alias("url"),
        labels().alias("labels"),
        *([content_html().alias("content_html")] if "content" in raw.columns else []),
        author("name").alias("author_name"),
        author("email").alias("author_email"),
        is_draft().alias("is_draft"),
        is_trashed().alias("is_trashed"),
        kind(tags).alias("kind"),
    )
    return with_route(with_issues(with_fallbacks(fields))).drop("raw_id", "raw_title")


def with_fallbacks(fields: DataFrame) -> DataFrame:
    """Generated `id` and `title` where the entry has none."""
    index = F.col("entry_index").cast("string")
    label = F.when(F.col("kind") == "post", "Post").otherwise(capitalized(F.col("kind")))
    return fields.withColumns({
        "id": F.when(F.col("raw_id") == "", F.concat(F.lit("generated:entry-"), index)).otherwise(F.col("raw_id")),
        "title": F.when(F.col("raw_title") == "", F.concat(F.lit("Untitled "), label, F.lit(" "), index))
        .otherwise(F.col("raw_title")),
    })


def with_issues(fields: DataFrame) -> DataFrame:
    """`issues`: what is odd about the entry, in the order it is found."""

    def issue(condition: Column, issue_type: str, post_id: str, title: str, message: str) -> Column:
        return F.when(condition, F.struct(
            F.lit("warning").alias("severity"),
            F.lit(issue_type).alias("issue_type"),
            F.col(post_id).alias("post_id"),
            F.col(title).alias("post_title"),
            F.format_string(message, "kind", "id", "title", F.col("entry_index").cast("string")).alias("message"),
        ))

    is_post = F.col("kind") == "post"
    live = ~F.col("is_draft") & ~F.col("is_trashed")
    found = F.array(
        issue(~F.col("kind").isin(KNOWN_KINDS), "unfamiliar_entry_type", "raw_id", "raw_title",
              UNFAMILIAR_TYPE),
        issue(F.col("raw_id") == "", "missing_id", "id", "raw_title",
              MISSING_ID),
        issue(is_post & (F.col("raw_title") == ""), "missing_title", "id", "title",
              MISSING_TITLE),
        issue(is_post & (F.col("published") == ""), "missing_publication_date", "id", "title",
              MISSING_DATE),
        issue(is_post & live & (F.coalesce("url", F.lit("")) == ""), "missing_url", "id", "title",
              MISSING_URL),
    )
    return fields.withColumn("issues", F.filter(found, lambda i: i.isNotNull()))


def with_route(entries: DataFrame) -> DataFrame:
    """`route` (skipped or published) with the kind and reason an entry is skipped under."""
    skip_kind = (
        F.when(F.col("is_trashed"), "trashed")
        .when(F.col("kind") != "post", F.col("kind"))
        .when(F.col("is_draft"), "draft")
    )
    reason = (
        F.when(F.col("is_trashed"), SKIPPED_TRASHED)
        .when(F.col("kind") != "post", F.format_string(SKIPPED_KIND, "kind"))
        .when(F.col("is_draft"), SKIPPED_DRAFT)
    )
    return entries.withColumns({
        "route": F.when(skip_kind.isNull(), "published").otherwise("skipped"),
        "skip_kind": skip_kind,
        "skip_reason": reason,
    })


def skipped(entries: DataFrame) -> DataFrame:
    return entries.where("route = 'skipped'").select(
        "feed_path", "entry_index", F.col("id").alias("post_id"), "title",
        F.col("skip_kind").alias("kind"), F.col("skip_reason").alias("reason"),
    )


def published(entries: DataFrame) -> DataFrame:
    return entries.where("route = 'published'")


def entry_issues(entries: DataFrame) -> DataFrame:
    """One row per issue found while reading entries; `seq` keeps the order inside an entry.

    The outer form keeps Spark from testing the array's size below all the projections that
    build it, where it would be computed a second time.
    """
    return entries.select(
        "feed_path", "entry_index", F.posexplode_outer("issues").alias("seq", "issue")
    ).where("issue IS NOT NULL").select("feed_path", "entry_index", "seq", "issue.*")
