"""Secrets in texts: three certain patterns, and weak parts that count only where complementary parts stand nearby.

Matches are found with the regular expressions of Spark SQL. The pieces of the text between the matches give their
offsets by running sums. An interval join then looks for the complements of a weak part in the scope around it, the stretch
that begins and ends a fixed number of code points from its start. Its equality key is a cell of the text, as long as that
distance: a scope meets its own cell and the two beside it, and of each the first and the last complement decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from requestlens.session import store


def either_case(word: str) -> str:
    """A pattern for the ASCII letters of a word in either case; flags for that differ between engines beyond ASCII."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _literal(pattern: str) -> str:
    """A pattern as a SQL string."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NAMES = "|".join(either_case(word) for word in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# kind, pattern, condition on the match m; the order of the kinds breaks ties of the start.
CERTAIN = [
    ("assign", ASSIGN, f"length(regexp_extract(m, {_literal('^' + ASSIGN)}, 1)) >= 6"),
    # A run too short for these two cannot hold a longer one, so their lengths stand in the patterns.
    ("access", r"AKIA[A-Z0-9]{16,}", "true"),
    ("hex", r"[0-9a-f]{24,}", "true"),
]
# Parts of a credential that mean little alone.
_HOLDERS = "|".join(either_case(word) for word in ("access_?key_?id", "client_?id", "user_?name", "user_?id", "login"))
WEAK = [
    ("weak_access", rf"(?:{_HOLDERS})[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.@=-]{{3,}}", "true"),
    ("weak_secret", r"[A-Za-z0-9+/=]{40,}", "length(m) = 40"),
    ("endpoint", r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp)://[^\x20\x09-\x0D\"'<>]+", "true"),
]
KINDS = [kind for kind, _, _ in CERTAIN + WEAK]
SCOPE = 400


def _found(kind_no: int, pattern: str, keep: str) -> str:
    """All matches of one kind in _text, each with its length and that of the gap before it."""
    literal = _literal(pattern)
    none = "cast(array() as array<struct<kind:int,i:int,gap:int,len:int,keep:boolean>>)"
    return (
        f"transform(array(regexp_extract_all(_text, {literal}, 0)), ms -> if(size(ms) = 0, {none}, "
        f"transform(array(split(_text, {literal}, -1)), gaps -> "
        f"transform(ms, (m, i) -> named_struct('kind', {kind_no}, 'i', i, 'gap', length(gaps[i]), 'len', length(m), 'keep', {keep})))[0]))[0]"
    )


def find_parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as (_row, doc_id), and parts as (_row, kind, start, end); offsets in code points, end exclusive.

    Both come from one pass over the texts, stored, so row numbers agree.
    """
    scanned = store(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text")
        ).select(
            "_row", "doc_id",
            F.concat(*[F.expr(_found(no, pattern, keep)) for no, (_, pattern, keep) in enumerate(CERTAIN + WEAK)]).alias("_found"),
        ),
        "secrets",
    )
    each = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (
        scanned.select("_row", F.inline("_found"))
        .withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(each))
        .where("keep")
        .select("_row", "kind", (F.col("end") - F.col("len")).alias("start"), "end")
    )
    return scanned.select("_row", "doc_id"), parts


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The certain parts, and the weak ones that complementary parts nearby confirm.

    The scope of a part reaches from ``scope`` code points before its start to as many after it, both included, and holds the
    parts that start there. A weak access identifier needs a secret in its scope (certain or weak), a weak secret an access
    identifier, an endpoint both. A weak part that a certain part covers adds nothing and is left out.

    A cell sends one row with the first and last start of either kind of complement, however many parts it holds: the last one
    in the cell before, any in the same and the first in the cell after are those nearest to a part. So a part meets three rows.
    """
    if scope < 1:
        raise ValueError("scope must be positive")
    before = Window.partitionBy("_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    certain_to = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(before)
    linked = store(parts.withColumn("_to", certain_to).where("kind < 3 OR _to IS NULL OR _to < end").drop("_to"), "parts")
    access, secret = (F.when(F.col("kind").isin(*kinds), F.col("start")) for kinds in ((1, 3), (0, 2, 4)))
    cells = linked.groupBy("_row", F.expr(f"start div {scope}").alias("_cell")).agg(
        F.min(access).alias("_access_from"), F.max(access).alias("_access_to"), F.min(secret).alias("_secret_from"), F.max(secret).alias("_secret_to")
    )
    weak = linked.where("kind >= 3").withColumn("_cell", F.explode(F.expr(f"transform(array(-1, 0, 1), d -> start div {scope} + d)")))

    def near(what: str) -> F.Column:
        return F.expr(f"coalesce(least(abs(_{what}_from - start), abs(_{what}_to - start)) <= {scope}, false)")

    confirmed = (
        weak.join(cells, ["_row", "_cell"])
        .groupBy("_row", "kind", "start", "end")
        .agg(F.max(near("access")).alias("_access"), F.max(near("secret")).alias("_secret"))
        .where("(kind = 3 AND _secret) OR (kind = 4 AND _access) OR (kind = 5 AND _access AND _secret)")
        .select("_row", "kind", "start", "end")
    )
    return linked.where("kind < 3").unionByName(confirmed)


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak.

    ``spans`` lists kind:start:end of every span by start, then kind, joined by commas; ``base_sha256`` is the SHA-256 of the same
    list of the certain kinds alone. A null text counts as empty; a text without spans has the digest of the empty string
    and empty spans. Every row of a repeated document gets its own result. An empty table gives no rows; other columns
    are not read.
    """
    rows, parts = find_parts(docs)
    spans = link_parts(parts, scope).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("_spans"))
    names = "array(" + ", ".join(f"'{kind}'" for kind in KINDS) + ")"
    joined = rows.join(spans, "_row", "left").withColumn("_spans", F.coalesce("_spans", F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")))

    def listed(condition: str) -> F.Column:
        return F.array_join(F.expr(f"transform(filter(_spans, s -> {condition}), s -> concat({names}[s.kind], ':', s.start, ':', s.end))"), ",")

    counts = [F.expr(f"cast(size(filter(_spans, s -> s.kind = {no})) as bigint)").alias(f"n_{kind}") for no, kind in enumerate(KINDS[:3])]
    return joined.select(
        "doc_id", *counts, F.sha2(listed("s.kind < 3").cast("binary"), 256).alias("base_sha256"), listed("true").alias("spans"),
        F.expr("cast(size(filter(_spans, s -> s.kind >= 3)) as bigint)").alias("n_weak"),
    )
