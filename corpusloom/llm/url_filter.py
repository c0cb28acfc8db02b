"""URL filter: hashed host-suffix and path-prefix expressions against a rule list."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.tables import ascii_lower, input_columns, repeated, with_copies

# Hex digits of the short hash that is joined on; the full digest confirms.
SHORT = 8
# Rules of one block; a block is broadcast (about 200 bytes a rule).
BLOCK_RULES = 200_000


def _host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _host_suffixes(host: Column) -> Column:
    """The host, and what follows each of its dots."""
    labels = F.split(host, r"\.", -1)
    starts = F.sequence(F.lit(1), F.size(labels))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _path_prefixes(path: Column, lengths: list[int]) -> Column:
    """The first characters of the path, for each length that a rule's path has."""
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _blocks(rules: DataFrame) -> Iterator[DataFrame]:
    """The rules in blocks small enough to broadcast; one block unless there are many rules."""
    n_blocks = -(-max(rules.count(), 1) // BLOCK_RULES)
    block = F.pmod(F.xxhash64("digest"), F.lit(n_blocks))
    for i in range(n_blocks):
        yield rules.where(block == i) if n_blocks > 1 else rules


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Judge each URL by the longest rule that fits it.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all its
    subdomains where the path starts with the rule's. The rule with the longest host and
    path together wins; then the longer host, then ``block``. Each URL is expanded into
    host suffixes times path prefixes, which are joined with the rules on ``SHORT`` digits of
    their SHA-256 and confirmed by the whole digest.

    Returns key, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``. A null URL, or
    one without ``://``, has an empty host and path, and so fits no rule. Repeated rows are
    judged once and returned as often as they came. No rules: all get ``default``. Rules with a null
    host are ignored; a null path is empty; rule hosts are lower-cased. Only the two named
    columns are read.
    """
    spec = rules.where("host IS NOT NULL").select(
        ascii_lower(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict"
    ).groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))
    spec = spec.withColumn("rule", F.concat("r_host", "r_path")).withColumn("digest", _digest(F.col("rule")))
    spec = spec.withColumn("short", F.substring("digest", 1, SHORT))
    lengths = [r[0] for r in spec.select(F.length("r_path")).distinct().collect()] or [0]

    found = with_copies(input_columns(pages, k=key, u=url), ["k", "u"])
    text = F.coalesce("u", F.lit(""))
    found = found.withColumns({"host": _host(text), "path": _path(text)})
    expressions = F.flatten(F.transform(
        _host_suffixes(F.col("host")),
        lambda h: F.transform(_path_prefixes(F.col("path"), sorted(lengths)), lambda p: F.concat(h, p)),
    ))
    best = F.struct(F.length("rule").alias("n"), F.length("r_host").alias("n_host"), "r_verdict", "rule")
    found = found.withColumn("best", F.lit(None).cast("struct<n:int,n_host:int,r_verdict:string,rule:string>"))
    same_host = F.col("host") != ""
    for block in _blocks(spec):
        tries = found.withColumn("e", F.explode_outer(F.when(same_host, expressions)))
        tries = tries.withColumn("e_digest", _digest(F.col("e")))
        tries = tries.withColumn("e_short", F.substring("e_digest", 1, SHORT))
        hit = (F.col("e_short") == F.col("short")) & (F.col("e_digest") == F.col("digest"))
        joined = tries.join(F.broadcast(block), hit, "left")
        joined = joined.withColumn("new", F.when(F.col("rule").isNotNull(), best))
        found = joined.groupBy("k", "u").agg(
            *[F.first(c).alias(c) for c in ("copies", "host", "path")],
            F.greatest(F.max("best"), F.max("new")).alias("best"),
        )
    verdict = F.coalesce(F.col("best.r_verdict"), F.lit(default))
    return repeated(found).select(
        F.col("k").alias(key), "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict")
    )
