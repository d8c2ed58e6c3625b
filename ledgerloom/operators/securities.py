"""Security master: codes, lookups, peers and their benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.dates import fye_month

MASTER_TTL_DAYS = 30


def sec_code(ticker: Column) -> Column:
    return F.concat(F.trim(ticker), F.lit("0"))


def ticker_of(code: Column) -> Column:
    """Ticker of a five-character security code; other codes stay as they are."""
    return F.when(F.length(code) == 5, F.substring(code, 1, 4)).otherwise(code)


def is_ticker(c: Column) -> Column:
    return c.rlike("^[0-9]{4}$")


def listed_filers(filers: DataFrame) -> DataFrame:
    """Rows of listed filers with a security code."""
    listing, code = F.trim("listing"), F.trim("sec_code")
    return filers.filter((listing != "") & (listing != "非上場") & (code != ""))


def security_master(filers: DataFrame, listed: DataFrame) -> DataFrame:
    """One row per security code from the filer list and the exchange's list; the filer row wins.

    Both sides are tagged, put together and grouped, so the merge costs one shuffle and no join. On
    repeated codes the last filer row and the first exchange row count.
    """
    left = listed_filers(filers).select(
        F.trim("sec_code").alias("sec_code"), F.lit(1).alias("side"), F.col("seq"),
        F.trim("edinet_code").alias("edinet_code"), F.trim("company_name").alias("company_name"),
        fye_month(F.col("fye_text")).alias("fye_month"),
    )
    right = listed.filter(F.trim("code") != "").select(
        F.trim("code").alias("sec_code"), F.lit(0).alias("side"), (-F.col("seq")).alias("seq"),
        F.lit("").alias("edinet_code"), F.trim("company_name").alias("company_name"),
        F.lit(None).cast("int").alias("fye_month"),
    )
    row = F.struct("edinet_code", "company_name", "fye_month")
    return (
        left.unionByName(right)
        .groupBy("sec_code")
        .agg(F.max_by(row, F.struct("side", "seq")).alias("r"))
        .select("sec_code", "r.edinet_code", "r.company_name", "r.fye_month")
    )


def resolve_tickers(wanted: DataFrame, master: DataFrame) -> DataFrame:
    """Left lookup of tickers in the master; ``found`` tells the misses."""
    right = master.select(
        F.col("sec_code").alias("m_sec_code"), "edinet_code", "company_name", "fye_month"
    )
    return wanted.join(right, sec_code(F.col("ticker")) == F.col("m_sec_code"), "left").select(
        "ticker", "edinet_code", "company_name", "fye_month", F.col("m_sec_code").isNotNull().alias("found")
    )


def resolve_edinet_codes(wanted: DataFrame, master: DataFrame) -> DataFrame:
    right = master.filter(F.col("edinet_code") != "").select(
        "edinet_code", "company_name", "sec_code", "fye_month", F.substring("sec_code", 1, 4).alias("ticker"),
        F.lit(True).alias("hit"),
    )
    return wanted.join(right, "edinet_code", "left").select(
        "edinet_code", "company_name", "sec_code", "ticker", "fye_month",
        F.coalesce("hit", F.lit(False)).alias("found"),
    )


def search_securities(master: DataFrame, name_part: str | None = None, month: int | None = None) -> DataFrame:
    out = master
    if month is not None:
        out = out.filter(F.col("fye_month") == month)
    if name_part is not None:
        out = out.filter(F.contains(F.lower("company_name"), F.lit(name_part.lower())))
    return out.select(
        "edinet_code", "company_name", "sec_code", F.substring("sec_code", 1, 4).alias("ticker"), "fye_month"
    )


def peer_candidates(companies: DataFrame, max_peers: int) -> DataFrame:
    """First ``max_peers`` + 1 companies of each industry in master order.

    A company's peers are always among these, whichever company asks, so an industry is never joined
    with itself. `row_number() <= n` lets Spark cut every task's rows to n per industry before the
    shuffle, so a large industry sends only n rows per task to one place.
    """
    w = Window.partitionBy("industry").orderBy("seq")
    return (
        companies.withColumn("place", F.row_number().over(w))
        .filter(F.col("place") <= max_peers + 1)
        .select("industry", "place", F.col("ticker").alias("peer_ticker"), F.col("company_name").alias("peer_name"))
    )


def select_peers(companies: DataFrame, max_peers: int = 10, figures: DataFrame | None = None) -> DataFrame:
    """Peers per company: same industry, not itself, the first ``max_peers`` in master order.

    ``figures`` (by ticker) are added to the few candidates of an industry before these meet the
    companies: joined afterwards, a candidate of a large industry would be a hot key.
    """
    candidates = peer_candidates(companies, max_peers)
    if figures is not None:
        candidates = candidates.join(figures.withColumnRenamed("ticker", "peer_ticker"), "peer_ticker", "left")
    extra = [] if figures is None else [c for c in figures.columns if c != "ticker"]
    own_place = candidates.select(F.col("peer_ticker").alias("ticker"), F.col("place").alias("own_place"))
    targets = companies.select("ticker", "industry").join(own_place, "ticker", "left")
    shift = F.when(F.col("place") > F.col("own_place"), 1).otherwise(0)
    return (
        targets.join(candidates, "industry")
        .filter((F.col("peer_ticker") != F.col("ticker")) & (F.col("place") - shift <= max_peers))
        .select("ticker", "industry", "peer_ticker", "peer_name", (F.col("place") - shift).alias("peer_rank"), *extra)
    )


def peer_warnings(companies: DataFrame, max_peers: int = 10) -> DataFrame:
    """Peer count per company with the warning level: fewer than 3, fewer than asked, or none."""
    sizes = companies.groupBy("industry").agg(F.count("*").alias("members"))
    n = F.least(F.col("members") - 1, F.lit(max_peers))
    return companies.join(sizes, "industry").select(
        "ticker", n.alias("peer_count"),
        F.when(n < 3, "below_minimum").when(n < max_peers, "below_requested").otherwise("none").alias("warning"),
    )


METRICS = ("roe", "roa", "operating_margin", "revenue_growth")


def benchmark_matrix(companies: DataFrame, snapshots: DataFrame, max_peers: int = 10) -> DataFrame:
    """Target and peer rows with their latest metrics; companies without any metric are flagged."""
    values = snapshots.select("ticker", *METRICS, F.lit(True).alias("has_snapshot"))
    peers = select_peers(companies, max_peers, values)
    own = companies.join(values, "ticker", "left")
    missing = F.coalesce(*[F.col(m) for m in METRICS]).isNull()
    row = lambda df, member, is_target: df.select(
        "ticker", F.col(member).alias("member"), F.lit(is_target).alias("is_target"), *METRICS,
        F.coalesce("has_snapshot", F.lit(False)).alias("has_snapshot"), missing.alias("all_missing"),
    )
    return row(peers, "peer_ticker", False).unionByName(row(own, "ticker", True))


def benchmark_reliability(matrix: DataFrame) -> DataFrame:
    peers = F.count_if(~F.col("is_target"))
    missing = F.count_if(~F.col("is_target") & F.col("all_missing"))
    return matrix.groupBy("ticker").agg(
        peers.alias("peer_count"), missing.alias("missing_peers_count"),
        ((peers > 0) & (missing < peers)).alias("benchmark_reliable"),
    )


def _middle(values: Column) -> Column:
    """Median of a sorted array; null when it is empty."""
    n = F.size(values)
    at = lambda i: F.try_element_at(values, F.greatest(i, F.lit(1)).cast("int"))
    return F.when(n > 0, (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2.0)


def benchmarks(matrix: DataFrame) -> DataFrame:
    """Median, mean, spread, quartiles and the target's percentile per company and metric.

    The quartiles are the medians of the halves without the middle value. A group is one company with
    at most ``max_peers`` peers, so the collected array has a fixed bound.
    """
    from ledgerloom.functions.numbers import round_to, round2

    long = matrix.unpivot(["ticker", "is_target"], list(METRICS), "metric", "value")
    grouped = long.groupBy("ticker", "metric").agg(
        F.array_sort(F.collect_list("value")).alias("v"),
        F.max(F.when(F.col("is_target"), F.col("value"))).alias("target"),
    )
    v, n = F.col("v"), F.size("v")
    # Summed in sorted order, so that the result does not depend on the order of arrival.
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    mean = total / n
    squares = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    half = F.floor(n / 2).cast("int")
    enough = n >= 2
    single = F.try_element_at(v, F.lit(1))
    rank = F.size(F.filter(v, lambda x: x <= F.col("target")))
    return grouped.select(
        "ticker", "metric",
        F.when(enough, round2(_middle(v))).otherwise(single).alias("median"),
        F.when(enough, round2(mean)).otherwise(single).alias("mean"),
        F.when(enough, round2(F.sqrt(squares / (n - 1)))).alias("std"),
        F.when(enough, round2(_middle(F.slice(v, F.lit(1), half)))).alias("q1"),
        F.when(enough, round2(_middle(F.slice(v, n - half + 1, half)))).alias("q3"),
        F.when(enough & F.col("target").isNotNull(), round_to(rank / n * 100.0, 1)).alias("target_percentile"),
    )
