"""Secret scan with corpus-wide ownership: who else holds a candidate tells examples from live credentials.

Base kinds are found by their patterns alone. Besides them every text yields candidates: the values of the base spans,
and long mixed tokens ("owned") that no base span touches. Candidates are counted over the corpus by distinct
repositories and owners. A value that several of them hold is a copied example; one that stays with its owner looks
live. Owned spans are added for live tokens only; base spans always stay.

Only DataFrame functions run here. Places come from windows over the matches of a text, so its time grows with their
number. Distinct (value, repository, owner) triples are made before values are counted, so a value that a third of all
rows hold shrinks map-side; values travel as 16-byte digests.

Defined results: null and empty texts have no spans; a null owner or part of a repository's name counts as the empty
one; repeated rows give equal rows, and their spans count for one owner; an empty table gives an empty one; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import content_key
from panelspark.operators.schema import fresh_name
from panelspark.session import materialise

# The base patterns and least lengths, in the order of the kinds.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "owned")

#: The method's own candidates: runs of 24 or more that hold an upper-case letter, a lower-case one and a digit.
OWNED = r"[A-Za-z0-9+/_-]{24,}"
#: A value is live while at most so many owners and repositories hold it.
MOST_OWNERS, MOST_REPOSITORIES = 1, 2
#: Code points of a block from which the pieces of a redacted text are read.
BLOCK = 1024


def _matches(text: str, pattern: str, kind: int, fits: Callable[[Column], Column], value_group: int = 0) -> Column:
    """Array of (kind, i, gap, n, value, fits) of the leftmost non-overlapping matches: the code points between a match
    and the one before, its own, the digest of its value and whether the value is one of the kind."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else matches
    pieces = F.arrays_zip(gaps.alias("gap"), F.transform(matches, F.length).alias("n"), values.alias("value"))
    told = F.transform(pieces, lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), p["gap"].alias("gap"), p["n"].alias("n"),
        F.unhex(F.md5(p["value"].cast("binary"))).alias("value"), fits(p["value"]).alias("fits"),
    ))
    # the stretch after the last match has none of its own
    told = F.filter(told, lambda p: p["n"].isNotNull())
    nothing = F.array().cast("array<struct<kind:int,i:int,gap:int,n:int,value:binary,fits:boolean>>")
    return F.when(F.col(text).rlike(pattern), told).otherwise(nothing)


def find_matches(docs: DataFrame, key: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """(row, key, owner, repository, matches): the matches of one document, ``row`` numbering the rows."""
    told = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    matches = F.concat(
        _matches("text", ASSIGN, 0, lambda v: F.length(v) >= LEAST_VALUE, 2),
        _matches("text", ACCESS, 1, lambda v: F.length(v) >= LEAST_ACCESS),
        _matches("text", HEX, 2, lambda v: F.lit(True)),
        _matches("text", OWNED, 3, lambda v: v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]")),
    )
    return told.select("row", "key", "owner", "repository", matches.alias("matches"))


def placed_spans(found: DataFrame) -> DataFrame:
    """(row, owner, repository, start, kind, stop, value) of the base spans and of the own ones that touch none.

    Running sums over a row's matches give the places. A base span that begins before an own one, or with it, touches it
    if it is the one that reaches furthest and does; of those that begin later the first decides. All are windows over
    one shuffle by row, so a text's time grows with the number of its matches and no more than its sorting.
    """
    each = found.filter(F.size("matches") > 0).select("row", "owner", "repository", F.explode("matches").alias("m"))
    each = each.select("row", "owner", "repository", "m.*").repartition("row")
    stop = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("row", "kind").orderBy("i")).cast("int")
    spans = each.withColumn("stop", stop).filter("fits").withColumn("start", F.col("stop") - F.col("n"))
    before = Window.partitionBy("row").orderBy("start", "kind", "stop")
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"), F.desc("stop"))
    base = F.col("kind") < 3
    spans = spans.withColumn("reach", F.max(F.when(base, F.col("stop"))).over(before))
    spans = spans.withColumn("next", F.min(F.when(base, F.col("start"))).over(after))
    touched = (F.coalesce("reach", "start") > F.col("start")) | (F.coalesce("next", "stop") < F.col("stop"))
    return spans.filter(base | ~touched).select("row", "owner", "repository", "start", "kind", "stop", "value")


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: list[str] | None = None,
) -> DataFrame:
    """(row, key, spans): one row for each row of ``docs``; spans are (start, kind, stop, live), ascending, with kinds
    numbered as in KINDS. A repository is the owner's name and the ``repository`` columns (``lang`` by default)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [owner, *(repository or ["lang"])]]
    told = materialise(find_matches(docs, key, text, F.col(owner).cast("string"), F.concat_ws("/", *parts)))
    spans = materialise(placed_spans(told))
    holders = spans.select("value", "owner", "repository").distinct()
    holders = holders.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    live = holders.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")).filter(
        (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)
    ).select("value", F.lit(True).alias("live"))
    judged = spans.select("row", "start", "kind", "stop", "value").join(live, "value", "left").select(
        "row", F.struct("start", "kind", "stop", F.coalesce("live", F.lit(False)).alias("live")).alias("span")
    ).filter("span.kind < 3 OR span.live")
    each = judged.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    none = F.array().cast(each.schema["spans"].dataType)
    return told.select("row", F.col("key").alias(key)).join(each, "row", "left").select(
        "row", key, F.coalesce("spans", none).alias("spans")
    )


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
    )), ",")


def digest_columns(spans: Column) -> list[Column]:
    """The counts, the digest of the base spans and the list of all spans."""
    base = F.filter(spans, lambda s: s["kind"] < 3)
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}")
        for k, name in enumerate(KINDS[:3])
    ]
    live = F.size(F.filter(base, lambda s: s["live"])).cast("bigint")
    return [
        *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"), live.alias("n_live"),
    ]


def _islands(found: DataFrame) -> DataFrame:
    """(row, starts, stops): the stretches that the spans of a row cover, touching ones as one, both ascending."""
    each = found.select("row", F.explode("spans").alias("span")).select("row", "span.start", "span.stop")
    order = Window.partitionBy("row").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("first", F.when(F.col("start") <= reach, 0).otherwise(1))
    each = each.withColumn("island", F.sum("first").over(order))
    whole = each.groupBy("row", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    # islands lie apart, so that sorted starts and sorted stops stay side by side
    return whole.groupBy("row").agg(
        F.array_sort(F.collect_list("start")).alias("starts"), F.array_sort(F.collect_list("stop")).alias("stops")
    )


def redacted(text: Column, starts: Column, stops: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch from a start to its stop replaced by the mark.

    Finding a code point means reading the text up to it, so the text is cut into blocks once, and what stays between
    two stretches is read from its own blocks alone.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    ends = F.concat(starts, F.array(F.length(text)))
    pieces = F.arrays_zip(F.concat(F.array(F.lit(0)), stops).alias("at"), ends.alias("to"))

    def piece(whole: Column, p: Column) -> Column:
        first = F.floor(p["at"] / BLOCK).cast("int")
        n = F.floor(p["to"] / BLOCK).cast("int") - first + 1
        return F.array_join(F.slice(whole, first + 1, n), "").substr(p["at"] - first * BLOCK + 1, p["to"] - p["at"])

    # a variable of an outer transform, so that the blocks are made once for a text and not for every piece
    state = F.array(F.struct(blocks.alias("blocks"), pieces.alias("pieces")))
    texts = F.transform(state, lambda t: F.array_join(F.transform(t["pieces"], lambda p: piece(t["blocks"], p)), mark))
    return F.element_at(texts, 1)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by a mark; ``n_chars``, where there is one, counts the new text."""
    content, hits = fresh_name("_content", docs.columns), fresh_name("_spans", docs.columns)
    keyed = docs.withColumn(content, content_key(key, text))
    found = materialise(scan(keyed, content, text).filter(F.size("spans") > 0).dropDuplicates([content]))
    covered = found.select("row", content).join(_islands(found), "row")
    covered = covered.select(content, F.struct("starts", "stops").alias(hits))
    told = keyed.join(materialise(covered), content, "left")
    places = F.col(hits)
    new = F.when(places.isNull(), F.col(text)).otherwise(redacted(F.col(text), places["starts"], places["stops"]))
    told = told.withColumn(text, new)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        told = told.withColumn("n_chars", F.when(F.col(hits).isNull(), F.col("n_chars")).otherwise(
            F.length(text)
        ).cast(kind))
    return told.select(docs.columns)
