"""Tables and selected columns named in a log of query texts.

Text patterns over a column of statements, meant for simple single-block selects
with joins; other statements are flagged rather than guessed at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.operators.joins import lookup_join

NAME = r"[A-Za-z_][A-Za-z0-9_]*"
_CLAUSES = (
    "left|right|inner|full|cross|join|on|where|group|order|limit|having|using|natural|outer|semi|anti|lateral|union|tablesample|for"
)
SOURCE = rf"(?i)\b(?:from|join)\s+{NAME}(?:\.{NAME})?(?:\s+as\s+{NAME}|\s+(?!(?:{_CLAUSES})\b){NAME})?"
#: One select block; not a nested one, a set operation or a common table expression.
SIMPLE = r"(?is)^\s*select\s(?!.*\b(?:select|union|intersect|except)\b)"
#: Lists of tables, names of three parts and quoted names, which the patterns do not read.
UNREAD = rf"(?is)\b(?:from|join)\s+(?:[`\"(]|{NAME}(?:\.{NAME})?\.(?:{NAME}\.|[`\"])|{NAME}\.{NAME}\.)"
#: A sample, whose alias comes late, or a FROM that belongs to a function or a comparison and not to the select.
INNER_FROM = r"(?is)\btablesample\b|\b(?:extract|substring|overlay|trim)\s*\([^()]*\bfrom\b|\bdistinct\s+from\b"
#: A quoted text, which is kept as the first group, or a comment.
COMMENT = r"('[^']*')|--[^\n]*|/\*[\s\S]*?\*/"
COMMA = rf"(?is)\b(?:from|join)\s+{NAME}(?:\.{NAME})?(?:\s+(?:as\s+)?(?!(?:{_CLAUSES})\b){NAME})?\s*,"
KEYWORDS = ("as", "distinct", "case", "when", "then", "else", "end", "and", "or", "not", "null", "is", "in", "like")


def _unquoted(sql: Column) -> Column:
    """The statement without comments and with empty quoted texts."""
    return F.regexp_replace(F.regexp_replace(sql, COMMENT, "$1 "), r"'[^']*'", "''")


def supported(text: Column) -> Column:
    """A single select block over plainly named, joined tables; of a statement as ``_unquoted`` leaves it."""
    unread = text.rlike(UNREAD) | text.rlike(COMMA) | text.rlike(INNER_FROM)
    return F.coalesce(text.rlike(SIMPLE) & ~unread, F.lit(False))


def _marked(log: DataFrame, query_id: str, sql: str) -> DataFrame:
    """Cleaned statements, null where the patterns cannot read them, so that nothing more is tried there."""
    cleaned = log.select(query_id, _unquoted(F.col(sql)).alias("_text"))
    return cleaned.select(query_id, F.when(supported(F.col("_text")), F.col("_text")).alias("_text"))


def _sources(sql: Column) -> Column:
    """``array<struct<database,table,alias>>`` of the FROM and JOIN clauses of a statement."""

    def one(text: Column) -> Column:
        words = F.split(F.lower(text), r"\s+")
        dotted = F.get(words, 1)
        table = F.substring_index(dotted, ".", -1)
        return F.struct(
            F.when(dotted.contains("."), F.substring_index(dotted, ".", 1)).alias("database"),
            table.alias("table"),
            F.when(F.size(words) > 2, F.element_at(words, -1)).otherwise(table).alias("alias"),
        )

    return F.transform(F.regexp_extract_all(sql, F.lit(SOURCE), F.lit(0)), one)


def tables(log: DataFrame, query_id: str, sql: str) -> DataFrame:
    """``(query, database, table, unsupported)``: one row per table of a statement.

    A statement that the patterns cannot read gives one row that says so. All names of a
    statement sit in one row, so they are made distinct there and nothing is shuffled.
    """
    names = F.array_distinct(F.transform(_sources(F.col("_text")), lambda s: F.struct(s["database"], s["table"])))
    unread = F.col("_text").isNull().alias("unsupported")
    found = _marked(log, query_id, sql).select(query_id, unread, F.explode_outer(names).alias("_s"))
    return found.where("unsupported or _s is not null").select(query_id, "_s.database", "_s.table", "unsupported")


def selected_columns(log: DataFrame, query_id: str, sql: str, catalogue: DataFrame) -> DataFrame:
    """``(query, table, column, unsupported)`` for the columns in the select list.

    ``catalogue`` is ``(table, column)``. Aliases resolve through the query's own tables,
    unqualified names through the catalogue. ``*`` stands for all columns only as a whole
    select item or after an alias. Join and filter conditions do not count. A statement
    that the patterns cannot read gives one row that says so.
    """
    unquoted = F.lower(F.regexp_extract("_text", r"(?is)^\s*select\s+(.*?)\s+from\s", 1))
    unnamed = F.regexp_replace(unquoted, rf"\bas\s+{NAME}", " ")
    # A star between commas, or after an alias; others multiply or count rows.
    starred = F.regexp_replace(unnamed, rf"(?<=^|,)\s*(?:distinct\s+)?\*\s*(?=,|$)", " _every_ ")
    starred = F.regexp_replace(starred, rf"({NAME})\.\*", r"$1._every_")
    token = rf"((?:{NAME}\.)?{NAME}\b(?!\s*\(|\.))"
    tokens = F.array_distinct(F.regexp_extract_all(starred, F.lit(token), F.lit(1)))
    picks = F.flatten(F.transform("_sources", lambda s: F.transform(
        F.filter("_tokens", lambda t: (~t.contains(".") & ~t.isin(*KEYWORDS)) | (F.substring_index(t, ".", 1) == s["alias"])),
        lambda t: F.struct(s["table"].alias("table"), F.substring_index(t, ".", -1).alias("_name")),
    )))
    chosen = _marked(log, query_id, sql).select(
        query_id, F.col("_text").isNull().alias("unsupported"), tokens.alias("_tokens"), _sources(F.col("_text")).alias("_sources")
    )
    # A column named beside a star of its table is part of that star.
    within = lambda all_, p: ~F.exists(all_, lambda q: (q["table"] == p["table"]) & (q["_name"] == "_every_"))
    kept = F.filter("_picks", lambda p: (p["_name"] == "_every_") | within(F.col("_picks"), p))
    listed_picks = chosen.select(query_id, "unsupported", F.array_distinct(picks).alias("_picks"))
    picked = listed_picks.select(query_id, "unsupported", F.explode_outer(kept).alias("_p")).where("unsupported or _p is not null")
    named_picks = picked.select(query_id, "unsupported", "_p.table", "_p._name")
    listed = catalogue.groupBy("table").agg(F.collect_set("column").alias("_columns"))  # one row per table
    joined = lookup_join(named_picks, listed, ["table"], [query_id], "left")
    names = F.when(F.col("_name") == "_every_", F.col("_columns")).when(F.array_contains("_columns", F.col("_name")), F.array("_name"))
    read = joined.select(query_id, "table", F.explode_outer(names).alias("column"), "unsupported")
    return read.where("unsupported or column is not null")


def ddl(columns: DataFrame, table: str = "table", position: str = "position",
        column: str = "column", kind: str = "type") -> DataFrame:
    """``create table`` text per table from its column rows, in position order."""
    entries = F.sort_array(F.collect_list(F.struct(position, column, kind)))
    body = F.array_join(F.transform(entries, lambda e: F.concat(e[column], F.lit("  "), e[kind])), ",")
    text = F.concat(F.lit("create table "), F.col(table), F.lit(" (  "), F.col("_body"), F.lit("  );"))
    return columns.groupBy(table).agg(body.alias("_body")).select(table, text.alias("ddl"))
