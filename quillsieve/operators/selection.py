"""Balanced selection under difficulty and domain quotas."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import DIFFICULTY_SHARES, DIVERSITY_WEIGHT, TARGET_SIZE
from quillsieve.functions.scales import difficulty_band
from quillsieve.operators.dedup import duplicate_clusters
from quillsieve.operators.diversity import diversity_scores, sample_features
from quillsieve.operators.gates import filter_by_quality, metric
from quillsieve.operators.ranking import IN_PLACE_ROWS, top_per_group
from quillsieve.session import lookup_join, stage

BANDS = ("easy", "medium", "hard")
_LENDERS = ("medium", "easy", "hard")
# Counts of (band, domain) that come to the driver; a domain is a category, not a web host.
MAX_CELLS = 1_000_000
_APART = "\x1f"  # between band and domain


def selection_score(diversity_weight: float = DIVERSITY_WEIGHT, diversity: str = "diversity_score") -> Column:
    """``overall * (1 - w) + diversity * w``; a missing part counts as 0."""
    diverse = F.coalesce(F.col(diversity), F.lit(0.0))
    return metric("overall_score", 0.0) * (1 - diversity_weight) + diverse * diversity_weight


def band_quotas(sizes: dict[str, int], target: int, shares: dict[str, float] | None = None) -> dict[str, int]:
    """Rows to take from the top of each band.

    Each band gets ``int(target * share)``, the remainder goes to medium; a band that
    is too small borrows from medium, easy and hard in that order. A band is always
    consumed from its top, so borrowing only raises the lender's count.
    """
    shares = DIFFICULTY_SHARES if shares is None else shares
    unknown = set(shares) - set(BANDS)
    if unknown:
        raise ValueError(f"unknown difficulty bands: {sorted(unknown)}")
    quota = {b: int(target * s) for b, s in shares.items()}
    if sum(quota.values()) < target:
        quota["medium"] = quota.get("medium", 0) + target - sum(quota.values())
    take = {b: min(quota.get(b, 0), sizes.get(b, 0)) for b in BANDS}
    for band, wanted in quota.items():
        missing = wanted - min(wanted, sizes.get(band, 0))
        for lender in _LENDERS:
            if lender != band and missing > 0:
                lent = min(missing, sizes.get(lender, 0) - take[lender])
                take[lender] += lent
                missing -= lent
    surplus = sum(take.values()) - target
    for band in reversed(list(quota)):
        cut = min(max(surplus, 0), take[band])
        take[band] -= cut
        surplus -= cut
    return take


def balanced_selection(
    df: DataFrame,
    target: int = TARGET_SIZE,
    shares: dict[str, float] | None = None,
    score: Column | None = None,
    band: Column | None = None,
    in_place: int = IN_PLACE_ROWS,
) -> DataFrame:
    """The best ``target`` rows by ``score`` with the band shares kept as far as the bands
    allow. With at most ``target`` rows all are returned. Only the three band sizes
    come to the driver."""
    band = difficulty_band(metric("instruction_complexity", 0.5)) if band is None else band
    score = selection_score() if score is None else score
    named = F.coalesce(F.col("id"), F.lit("")) != ""
    counts = {
        (r["b"], r["named"]): r["count"] for r in df.groupBy(band.alias("b"), named.alias("named")).count().collect()
    }
    if sum(counts.values()) <= target:
        return df
    sizes = {b: counts.get((b, True), 0) for b in BANDS}
    quotas = band_quotas(sizes, target, shares)
    return top_per_group(df.where(named), quotas, score, group=band, in_place=in_place)


def domain_quotas(
    sizes: dict[str, int],
    target: int,
    min_per_domain: int = 0,
    distribution: dict[str, float] | None = None,
) -> dict[str, int]:
    """Rows per domain: the given shares, or equal shares without any; at least
    ``min_per_domain`` where the domain has them; what a small domain leaves open is
    handed to the others, largest first."""
    if not sizes:
        return {}
    shares = distribution or {d: 1.0 / len(sizes) for d in sizes}
    take = {}
    for d, n in sizes.items():
        take[d] = min(n, max(int(target * shares.get(d, 0.0)), min_per_domain))
    left = target - sum(take.values())
    for d in sorted(sizes, key=lambda d: (-sizes[d], d)):
        more = min(max(left, 0), sizes[d] - take[d])
        take[d] += more
        left -= more
    return take


def domain_selection(
    df: DataFrame,
    target: int,
    min_per_domain: int = 0,
    distribution: dict[str, float] | None = None,
    score: Column | None = None,
    domain: Column | None = None,
) -> DataFrame:
    """The best rows by ``score`` within :func:`domain_quotas`. The counts of the domains
    come to the driver."""
    domain = F.coalesce(F.col("metadata.domain"), F.lit("unknown")) if domain is None else domain
    counted = df.groupBy(domain.alias("d")).count().limit(MAX_CELLS + 1).collect()
    if len(counted) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} domains: group them first")
    sizes = {r["d"]: r["count"] for r in counted}
    quotas = domain_quotas(sizes, target, min_per_domain, distribution)
    return top_per_group(df, quotas, selection_score() if score is None else score, group=domain)


def _floor_share(counts: dict[str, int], wanted: int) -> dict[str, int]:
    """Split ``wanted`` rows of a domain over its bands in proportion to their counts: unit k of
    a band of n stands at (2k - 1) / n, the first units are taken, the easier band first
    at the same place."""
    total = sum(counts.values())
    take = {b: max(0, wanted * n // total - 2) for b, n in counts.items()}
    queue = [((2 * take[b] + 1) / n, BANDS.index(b), b) for b, n in counts.items() if take[b] < n]
    heapq.heapify(queue)
    for _ in range(wanted - sum(take.values())):
        _, place, b = heapq.heappop(queue)
        take[b] += 1
        if take[b] < counts[b]:
            heapq.heappush(queue, ((2 * take[b] + 1) / counts[b], place, b))
    return take


def cell_quotas(
    cells: dict[tuple[str, str], int],
    target: int,
    shares: dict[str, float] | None = None,
    min_per_domain: int = 0,
    balance: bool = False,
) -> tuple[dict[tuple[str, str], int], dict[str, int]]:
    """Rows to take from the top of each cell (band, domain), and further rows by band
    whatever their domain, from the counts of the cells alone.

    The bands get :func:`band_quotas`. Each domain is sure of ``min_per_domain`` rows, of
    all its rows if it has fewer, and of ``target // domains`` if that is less; they are split over its bands
    in proportion. What is sure goes first; where it exceeds a band's quota, the other
    bands give way, each time the one that has most left of its quota. With ``balance``
    the rest of a band goes round its domains one row at a time until they are used up, so
    domains get equal shares; without, the rest has no domain.
    """
    bands = {b: sum(n for (c, _), n in cells.items() if c == b) for b in BANDS}
    if sum(bands.values()) <= target:
        return {c: n for c, n in cells.items() if n}, {}
    domains: dict[str, dict[str, int]] = {}
    for (b, d), n in cells.items():
        if n:
            domains.setdefault(d, {})[b] = n
    quota = band_quotas(bands, target, shares)
    least = min(min_per_domain, target // len(domains))
    sure = {(b, d): n for d, counts in domains.items() for b, n in _floor_share(counts, min(least, sum(counts.values()))).items()}
    held = {b: sum(n for (c, _), n in sure.items() if c == b) for b in BANDS}
    take = {b: max(quota[b], held[b]) for b in BANDS}
    queue = [(-1.0, -BANDS.index(b), b) for b in BANDS if take[b] > held[b]]
    heapq.heapify(queue)
    for _ in range(sum(take.values()) - sum(quota.values())):
        _, place, b = heapq.heappop(queue)
        take[b] -= 1
        if take[b] > held[b]:
            heapq.heappush(queue, (-take[b] / quota[b], place, b))
    rest = {b: take[b] - held[b] for b in BANDS if take[b] > held[b]}
    if not balance:
        return {c: n for c, n in sure.items() if n}, rest
    for b, more in rest.items():
        own = {d: counts[b] for d, counts in domains.items() if b in counts}
        low, high = 0, max(own.values())  # the level up to which every domain is filled
        while low < high:
            middle = (low + high + 1) // 2
            if sum(max(0, min(n, middle) - sure[b, d]) for d, n in own.items()) <= more:
                low = middle
            else:
                high = middle - 1
        before = sum(max(0, min(n, low) - sure[b, d]) for d, n in own.items())
        level = {d: max(sure[b, d], min(n, low)) for d, n in own.items()}
        for d in sorted(d for d, n in own.items() if n > low and sure[b, d] <= low)[: more - before]:
            level[d] = low + 1
        sure.update({(b, d): n for d, n in level.items()})
    return {c: n for c, n in sure.items() if n}, {}


def cell_selection(
    df: DataFrame,
    target: int,
    shares: dict[str, float] | None = None,
    min_per_domain: int = 0,
    balance: bool = False,
    score: Column | None = None,
    band: Column | None = None,
    domain: Column | None = None,
) -> DataFrame:
    """The best ``target`` rows by ``score`` within :func:`cell_quotas`. Rows need an id.
    Only the counts of the cells come to the driver; narrow rows are ranked."""
    band = difficulty_band(metric("instruction_complexity", 0.5)) if band is None else band
    domain = F.col("metadata.domain") if domain is None else domain
    domain = F.coalesce(domain, F.lit("unknown"))
    score = selection_score() if score is None else score
    df = df.where(F.coalesce(F.col("id"), F.lit("")) != "")
    counted = df.groupBy(band.alias("b"), domain.alias("d")).count().limit(MAX_CELLS + 1).collect()
    if len(counted) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of band and domain: group the domains first")
    cells = {(r["b"], r["d"]): r["count"] for r in counted}
    if sum(cells.values()) <= target:
        return df
    quotas, rest = cell_quotas(cells, target, shares, min_per_domain, balance)
    picked = top_per_group(df, {_APART.join(c): n for c, n in quotas.items()}, score, group=F.concat_ws(_APART, band, domain))
    if not rest:
        return picked
    others = df
    if quotas:
        picked = stage(picked, "sure-rows")
        others = lookup_join(df, picked.select("id"), ["id"], "left_anti", bound=sum(quotas.values()))
    return picked.unionByName(top_per_group(others, rest, score, group=band))


def multi_dimension_filter(
    df: DataFrame,
    target: int = TARGET_SIZE,
    quality_threshold: float = 0.7,
    diversity_weight: float = DIVERSITY_WEIGHT,
    shares: dict[str, float] | None = None,
    gate: dict | None = None,
    weights: dict[str, float] | None = None,
    similarity_threshold: float | None = None,
    text: Column | None = None,
    min_domain_samples: int = 0,
    domain_balance: bool = False,
) -> DataFrame:
    """Quality gate, then near duplicates out, then diversity of what is left, then balanced
    selection.

    With a ``similarity_threshold`` one row of each group of near duplicates stays, that with
    the highest overall score (to nine digits), then the smallest id; ``text`` is what is compared, by
    default the instruction and the response. ``min_domain_samples`` and
    ``domain_balance`` select within :func:`cell_quotas`.

    Only id, features, score, band and domain of the passing rows are staged and ranked, and their
    text if near duplicates go; the wide rows are read again at the end and joined with the
    selected ids, of which there are at most ``target``. Rows need an id. Adds ``selection_score`` and
    ``diversity_score``.
    """
    features = sample_features()
    gated = filter_by_quality(df, quality_threshold, **(gate or {}))
    columns = [
        "id", *[c.alias(f"f_{n}") for n, c in features.items()], metric("overall_score", 0.0).alias("overall"),
        difficulty_band(metric("instruction_complexity", 0.5)).alias("band"), F.coalesce("metadata.domain", F.lit("unknown")).alias("domain"),
    ]
    if similarity_threshold is None:
        narrow = stage(gated.select(*columns), "gated")
    else:
        text = F.concat_ws("\n", "instruction", "response.origin_text") if text is None else text
        passed = stage(gated.select(*columns, text.alias("text")), "gated")  # scored once, read several times
        narrow = passed.drop("text")
        clusters = duplicate_clusters(passed, F.col("text"), F.round("overall", 9), similarity_threshold)
        narrow = stage(lookup_join(narrow, clusters.where(F.col("id") != F.col("keeper")).select("id"), ["id"], "left_anti"), "unlike")
    diverse = diversity_scores(narrow, {n: F.col(f"f_{n}") for n in features}, weights)
    score = F.col("overall") * (1 - diversity_weight) + F.col("diversity_score") * diversity_weight
    scored = stage(diverse.select("id", "band", "domain", "diversity_score", score.alias("selection_score")), "scored")
    if min_domain_samples or domain_balance:
        picked = cell_selection(scored, target, shares, min_domain_samples, domain_balance, F.col("selection_score"), F.col("band"), F.col("domain"))
    else:
        picked = balanced_selection(scored, target, shares, score=F.col("selection_score"), band=F.col("band"))
    return lookup_join(df, picked.drop("band", "domain"), ["id"], "inner", bound=target).select(
        *df.columns, "selection_score", "diversity_score"
    )


def filtering_record(
    candidates: DataFrame,
    selected: DataFrame,
    passes: Column,
    filtered_at: str,
    diversity_weight: float = DIVERSITY_WEIGHT,
) -> DataFrame:
    """Every candidate with a ``filtering`` struct: whether it was selected, why, its
    scores and the time stamp. ``selected`` carries id, selection_score and
    diversity_score."""
    chosen = selected.select(
        "id", F.lit(True).alias("__selected"), F.col("selection_score").alias("__score"),
        F.col("diversity_score").alias("__diversity"),
    )
    reason = (
        F.when(F.col("__selected"), "selected")
        .when(~F.coalesce(passes, F.lit(False)), "below_quality_threshold")
        .otherwise("outside_quota")
    )
    return lookup_join(candidates, chosen, ["id"]).withColumn("filtering", F.struct(
        F.coalesce("__selected", F.lit(False)).alias("selected"),
        reason.alias("reason"),
        F.col("__score").alias("selection_score"),
        (metric("overall_score", 0.0) * (1 - diversity_weight)).alias("quality_contribution"),
        (F.col("__diversity") * diversity_weight).alias("diversity_contribution"),
        F.lit(filtered_at).cast("timestamp").alias("filtering_timestamp"),
    )).drop("__selected", "__score", "__diversity")
