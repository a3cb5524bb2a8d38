"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Spans are found with Java regular expressions: the pieces between the matches
of a pattern (``split``) and the matches themselves (``regexp_extract_all``)
give every start and end by prefix sums, in code points, without a Python
function.  Every candidate value is hashed; one aggregation counts in how many
repositories and by how many owners each hash occurs.  A value of more than
``max_owners`` owners or in more than ``max_repos`` repositories is a widely
copied example; the others are owner-specific.  A bare token that is
owner-specific and looks live (a digit, a lower-case letter and six distinct
characters at least) joins the spans.

Edge cases: null or empty text has no spans; null owners and repositories count
as one owner named ''; repeated rows are each scanned and count once for their
owner; other columns of the input are ignored, whatever their names.  Work grows
with a text's length and but little faster with its spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, small

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group holding the value, least length of that group.
BASE = (("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24))
#: Bare long tokens, which only the corpus statistics can tell from identifiers.
BARE = ("bare", r"[A-Za-z0-9+/_-]{32,}", 0, 32)

SPANS = "array<struct<start:bigint,ord:int,kind:string,end:bigint,hash:binary,live:boolean>>"


def _looks_live(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 6)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


PLACES = "array<struct<s:bigint,e:bigint>>"


def _places(sizes: Column) -> Column:
    """(s, e) of every match from the lengths g of the gap before it and m of itself.

    An array grows by copying, so the sums run over about sqrt(n) pieces of sqrt(n) each.
    """

    def running(piece: Column) -> Column:
        return F.aggregate(
            piece,
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(PLACES).alias("got")),
            lambda acc, x: F.struct(
                (acc["at"] + x["g"] + x["m"]).alias("at"),
                F.concat(acc["got"], F.array(F.struct((acc["at"] + x["g"]).alias("s"), (acc["at"] + x["g"] + x["m"]).alias("e")))).alias("got"),
            ),
        )

    def whole(all_: Column) -> Column:
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(all_)))).cast("int")
        pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(all_) - 1), step), lambda at: running(F.slice(all_, at + 1, step)))
        shifted = F.aggregate(
            pieces,
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{PLACES}>").alias("got")),
            lambda acc, p: F.struct(
                (acc["at"] + p["at"]).alias("at"),
                F.concat(acc["got"], F.array(F.transform(p["got"], lambda x: F.struct((x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"))))).alias("got"),
            ),
            lambda acc: F.flatten(acc["got"]),
        )
        return shifted

    return _let(sizes, whole)


def find_spans(text: Column, ord_: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of spans of one kind, leftmost non-overlapping, shorter values dropped."""
    rx = F.lit(pattern)
    full = F.regexp_extract_all(text, rx, F.lit(0))
    value = full if group == 0 else F.regexp_extract_all(text, rx, F.lit(group))
    sizes = F.zip_with(F.split(text, pattern, -1), full, lambda g, m: F.struct(F.length(g).cast("long").alias("g"), F.length(m).cast("long").alias("m")))
    spans = F.filter(
        F.zip_with(_places(F.filter(sizes, lambda x: x["m"].isNotNull())), value, lambda p, v: F.struct(p["s"].alias("s"), p["e"].alias("e"), v.alias("v"))),
        lambda x: F.length(x["v"]) >= least,
    )
    typed = F.transform(
        spans,
        lambda x: F.struct(
            x["s"].alias("start"), F.lit(ord_).alias("ord"), F.lit(kind).alias("kind"), x["e"].alias("end"),
            F.unhex(F.substring(F.sha2(x["v"], 256), 1, 32)).alias("hash"), _looks_live(x["v"]).alias("live"),
        ),
    )
    return F.when(text.rlike(pattern), typed).otherwise(F.array().cast(SPANS))


def _free(cands: DataFrame) -> DataFrame:
    """Without bare tokens that overlap a base span, by two passes over a text's spans."""
    base = F.col("ord") < len(BASE)
    forward = Window.partitionBy("_uid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy("_uid").orderBy((-F.col("start")).alias("_back")).rangeBetween(Window.unboundedPreceding, 0)
    seen = cands.withColumn("_upto", F.max(F.when(base, F.col("end"))).over(forward)).withColumn("_from", F.min(F.when(base, F.col("start"))).over(backward))
    overlaps = (F.coalesce("_upto", F.lit(-1)) > F.col("start")) | F.coalesce(F.col("_from") < F.col("end"), F.lit(False))
    return seen.where(base | ~overlaps).drop("_upto", "_from")


def scan(docs: DataFrame, owner: Column, repo: Column, text: str = "text", max_owners: int = 2, max_repos: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: ``keep`` columns, base spans and all spans.

    Columns: ``keep``..., ``base`` and ``spans`` (arrays of start, ord, kind,
    end), ``n_live`` and ``n_shared`` (values judged owner-specific and widely
    copied), ``marks`` (array of start, end, shared: the spans, those that overlap
    as one, which is shared if all of it is).
    Base spans always stay; a bare token joins them only if it looks live, lies
    in no base span and its hash is no widely copied one.
    """
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_uid"),
        *[docs[k] for k in keep],
        F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("_repo"),
        F.concat(*[find_spans(body, i, *x) for i, x in enumerate(BASE)]).alias("_base"),
        F.filter(find_spans(body, len(BASE), *BARE), lambda x: x["live"]).alias("_bare"),
    )
    rows = cut(rows, "secret-spans")

    cands = rows.where((F.size("_base") > 0) | (F.size("_bare") > 0)).select("_uid", "_owner", "_repo", F.explode(F.concat("_base", "_bare")).alias("s"))
    cands = cut(_free(cands.select("_uid", "_owner", "_repo", "s.start", "s.ord", "s.kind", "s.end", "s.hash")), "secret-candidates")
    # a hot value sends one row an owner and task, and one a repository
    owners = cands.groupBy("hash", "_owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("owners"))
    repos = cands.groupBy("hash", "_repo").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("repos"))
    copied = owners.join(repos, "hash").where((F.col("owners") > max_owners) | (F.col("repos") > max_repos)).select("hash", F.lit(True).alias("shared"))
    judged = cands.join(small(cut(copied, "copied-values")), "hash", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))
    judged = judged.where((F.col("ord") < len(BASE)) | ~F.col("shared"))
    order = Window.partitionBy("_uid").orderBy("start", "ord")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    judged = judged.withColumn("_new", (F.coalesce(before, F.lit(0)) <= F.col("start")).cast("int")).withColumn("_mark", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = judged.groupBy("_uid", "_mark").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.bool_and("shared").alias("shared"),
        F.collect_list(F.struct("start", "ord", "kind", "end", "shared")).alias("spans"),
    )
    kept = merged.groupBy("_uid").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("_all"), F.array_sort(F.collect_list(F.struct("start", "end", "shared"))).alias("_marks")
    )
    plain = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint,shared:boolean>>")
    out = rows.join(kept, "_uid", "left").withColumn("_all", F.coalesce("_all", none))
    return out.select(
        *[out[k] for k in keep],
        F.array_sort(plain("_base")).alias("base"),
        plain("_all").alias("spans"),
        F.size(F.filter("_all", lambda s: ~s["shared"])).cast("long").alias("n_live"),
        F.size(F.filter("_all", lambda s: s["shared"])).cast("long").alias("n_shared"),
        F.coalesce("_marks", F.array().cast("array<struct<start:bigint,end:bigint,shared:boolean>>")).alias("marks"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract columns of a scan with ``doc_id`` kept."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        "n_live", "n_shared",
    )


#: Code points of a piece of a text that is cut at many places.
PIECE = 4096


def redact(text: Column, marks: Column, live: str = "<secret>", example: str = "<example-secret>") -> Column:
    """``text`` with the ``marks`` of :func:`scan` replaced.

    A place in a text is found by counting from its start; so the text is cut into
    pieces first, and what lies between two marks is taken from the pieces it touches.
    """

    def between(pieces: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, F.floor((b - 1) / PIECE).cast("int") - first + 1), "")
        return F.when(a < b, some.substr((a - first * PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    def rebuilt(both: Column) -> Column:
        m, pieces, size = both["m"], both["p"], both["n"]
        before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(m, i - 1)["end"])
        parts = F.transform(m, lambda s, i: F.concat(between(pieces, before(i), s["start"]), F.when(s["shared"], F.lit(example)).otherwise(F.lit(live))))
        return F.concat(F.array_join(parts, ""), between(pieces, F.element_at(m, -1)["end"], size))

    cut_up = F.struct(marks.alias("m"), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("p"), F.length(text).cast("long").alias("n"))
    return F.when(F.size(marks) == 0, text).otherwise(_let(cut_up, rebuilt))


def _sql_hits(ord_: int, kind: str, pattern: str, group: int, least: int) -> str:
    rx = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT rid, doc_id, owner, repo, {ord_} AS ord, '{kind}' AS kind, s, s + length(m) AS e, v
  FROM (SELECT rid, doc_id, owner, repo, unnest(list_transform(range(1, len(ms) + 1), lambda i:
          list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0)))::BIGINT AS s,
          unnest(ms) AS m, unnest(vs) AS v
        FROM (SELECT rid, doc_id, owner, repo, string_split_regex(t, {rx}) AS gaps, regexp_extract_all(t, {rx}, 0) AS ms,
                     regexp_extract_all(t, {rx}, {group}) AS vs FROM d WHERE regexp_matches(t, {rx})))
  WHERE length(v) >= {least}"""


#: DuckDB SQL of :func:`digest` over ``documents`` (owner: source, repository: source and language).
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS t FROM documents),
base AS ({" UNION ALL ".join(_sql_hits(i, *x) for i, x in enumerate(BASE))}),
bare AS (SELECT * FROM ({_sql_hits(len(BASE), *BARE)}) b
  WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND len(list_distinct(string_split(v, ''))) >= 6
    AND NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = b.rid AND x.s < b.e AND b.s < x.e)),
cand AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
freq AS (SELECT v, count(DISTINCT owner) > 2 OR count(DISTINCT repo) > 4 AS shared FROM cand GROUP BY v),
kept AS (SELECT c.*, f.shared, kind || ':' || s || ':' || e AS z FROM cand c JOIN freq f USING (v) WHERE ord < 3 OR NOT f.shared),
by_doc AS (SELECT rid, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
  coalesce(string_agg(z, ',' ORDER BY s, ord) FILTER (ord < 3), '') AS b, string_agg(z, ',' ORDER BY s, ord) AS spans,
  count(*) FILTER (NOT shared) AS n_live, count(*) FILTER (shared) AS n_shared FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_shared, 0)::BIGINT AS n_shared
FROM d LEFT JOIN by_doc USING (rid)
"""
