"""Evidence and decisions by people: probes of addresses, picks for review, confirmations, reconciliation, hydration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.functions.names import name_facts
from prodlake.functions.similarity import indel_ratio
from prodlake.functions.text import blank, full_name, host, plain_name, squeeze, trim_space
from prodlake.operators.audit import broken_rules
from prodlake.operators.records import prefer, top_per_key

#: Hosts that show search results and thumbnails, never a product's own page.
SEARCH_HOSTS = ("search.naver.com", "msearch.naver.com", "search.shopping.naver.com", "search.pstatic.net", "www.google.com", "images.google.com", "www.bing.com")
#: Answers of pages that are there but turn machines away.
GUARDED = (401, 403, 429)
SMALLEST_SIDE, SMALLEST_AREA = 150, 20_000


def image_probes(rows: DataFrame, probes: DataFrame, url: str = "image_url") -> DataFrame:
    """S-24: rows with what a recorded probe (url, status, final_url, content_type, byte_count, width, height, sha256) says of their image.

    Adds `error` (empty if the image is fine) and `warnings`. Each address is probed once, however many rows have it.
    """
    found = rows.join(probes.withColumnRenamed("url", "_url"), F.col(url) == F.col("_url"), "left").drop("_url")
    status, kind = F.col("status"), F.lower(blank(F.col("content_type")))
    error = (
        F.when(status.isNull(), "not_probed")
        .when(~status.between(200, 399), F.concat(F.lit("http_"), status.cast("string")))
        .when(F.startswith(kind, F.lit("text/html")), "non_image_content_type")
        .otherwise("")
    )
    fine = error == ""
    warnings = {
        "search_thumbnail_url": host(F.col(url)).isin(*SEARCH_HOSTS),
        "redirected_to_search_thumbnail": host(F.col("final_url")).isin(*SEARCH_HOSTS),
        "missing_or_nonstandard_image_content_type": fine & ~F.startswith(kind, F.lit("image/")),
        "image_too_small": fine & ((F.greatest("width", "height") < SMALLEST_SIDE) | (F.col("width") * F.col("height") < SMALLEST_AREA)),
    }
    return found.withColumns({"error": error, "warnings": broken_rules(warnings)})


def page_error(url: Column, status: Column, final_url: Column) -> Column:
    """S-24: what is wrong with a source page by its probe; empty if it counts as there."""
    scheme = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("")))
    return (
        F.when(~scheme.isin("http", "https") | (host(url) == "") | host(url).isin(*SEARCH_HOSTS), "invalid_or_search_page_url")
        .when(status.isNull(), "not_probed")
        .when(host(final_url).isin(*SEARCH_HOSTS), "redirected_to_search_page")
        .when((status < 400) | status.isin(*GUARDED), "")
        .otherwise(F.concat(F.lit("http_"), status.cast("string")))
    )


def first_valid(x: Column, valid) -> Column:
    """D-12: the first part of a text parted by @ or | that is valid, else empty."""
    return F.coalesce(F.get(all_valid(x, valid), F.lit(0)), F.lit(""))


def all_valid(x: Column, valid) -> Column:
    return F.filter(F.transform(F.split(blank(x), "[@|]"), trim_space), valid)


def best_name(pairs: DataFrame, key: str, query: str, name: str, place: str, least: int = 78, ratio=indel_ratio) -> DataFrame:
    """E-11: of each key's candidates the one whose plain name is most alike, the first of equals; below `least` there is no match.

    The ratio is compared whole and returned truncated.
    """
    rated = pairs.withColumn("_ratio", ratio(plain_name(F.col(query)), plain_name(F.col(name))))
    best = top_per_key(rated, [key], [F.desc("_ratio"), F.asc(place)])
    return best.select(key, F.when(F.col("_ratio") >= least, F.col(name)).alias("match"), F.floor("_ratio").cast("int").alias("score"))


def retail_pick(candidates: DataFrame, key: str) -> DataFrame:
    """E-19: of each key's listings (catalog_name, candidate_name, match_score, rank, image_url) the one to be reviewed.

    Those that hold the whole catalogue name, of five letters or more, go first; then the score, then the rank. None is
    ever confirmed by itself.
    """
    target = full_name(F.col("catalog_name"))
    safe = (F.length(target) >= 5) & F.contains(full_name(F.col("candidate_name")), target)
    best = top_per_key(candidates.withColumn("safe", safe), [key], [F.desc("safe"), F.desc("match_score"), F.asc("rank")])
    return best.select(key, "candidate_name", "match_score", "image_url", "safe", F.when(blank(F.col("image_url")) != "", "review_required").otherwise("not_found").alias("status"))


def reconcile(products: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """J-17: manual against automatic decisions, one row a reviewed product: `outcome` is disagreement, manual_confirmation or agreement.

    products: (key, automatic_status, automatic_code); reviews: (key, decision, manual_code). A caller that must not go on with
    disagreements asks require_none() of them.
    """
    joined = reviews.join(products, key)
    manual, automatic = F.col("decision") == "confirmed", F.col("automatic_status") == "confirmed"
    same = blank(F.col("automatic_code")) == blank(F.col("manual_code"))
    outcome = F.when(automatic & ~(manual & same), "disagreement").when(manual & ~automatic, "manual_confirmation").otherwise("agreement")
    return joined.withColumn("outcome", outcome)


def require_none(rows: DataFrame, what: str) -> None:
    """Stop if there is any row, naming the first."""
    if first := rows.limit(1).collect():
        raise ValueError(f"{what}: {first[0].asDict()}")


def manual_confirmation(reviews: DataFrame, details: DataFrame, current: DataFrame) -> DataFrame:
    """E-20: reviewed products whose page was read and says the reviewed name, blanks aside, are confirmed with 95 points at least.

    reviews: (id, code, reviewed_name, rationale); details: (code, official_name, page columns ...); current: (id, score, image_url).
    What current rows already have of an image stays (J-16). `problem` says why a row is not confirmed.
    """
    tight = lambda c: F.replace(blank(F.col(c)), F.lit(" "), F.lit(""))
    joined = reviews.join(details.withColumnRenamed("image_url", "page_image"), "code", "left").join(current, "id", "left")
    problem = F.when(F.col("official_name").isNull(), "no_detail").when(tight("official_name") != tight("reviewed_name"), "name_differs").otherwise("")
    sure = problem == ""
    return joined.select(
        "id",
        "code",
        problem.alias("problem"),
        F.when(sure, "confirmed").otherwise("review_required").alias("status"),
        F.when(sure, F.greatest(F.lit(95), F.coalesce("score", F.lit(0)))).otherwise(F.coalesce("score", F.lit(0))).alias("score"),
        F.when(sure, prefer("image_url", "page_image")).otherwise(blank(F.col("image_url"))).alias("image_url"),
        F.when(sure, squeeze(F.col("rationale"))).otherwise("").alias("reason"),
    )


def review_materialised(records: DataFrame, approved: DataFrame, key: str, audit_columns: tuple[str, ...] = ("source_check", "image_check", "automated_failures", "automated_valid")) -> DataFrame:
    """M-09, P-11: approved records are confirmed by hand and eye; other confirmed ones go back to review without their addresses.

    `refused` marks an approval of a record that the automatic checks did not pass; columns of the audit are left out.
    """
    joined = records.join(approved.select(key, F.lit(True).alias("_approved")).distinct(), key, "left")
    told, confirmed = F.coalesce("_approved", F.lit(False)), F.col("status") == "confirmed"
    passed = confirmed & F.coalesce("automated_valid", F.lit(False))
    demoted = ~told & confirmed
    emptied = {c: F.when(demoted, "").otherwise(F.col(c)) for c in ("image_url", "source_url", "result_url") if c in records.columns}
    checked = {c: F.when(told, True).when(demoted, False).otherwise(F.col(c) if c in records.columns else F.lit(None)) for c in ("manual_verified", "visual_verified")}
    out = joined.withColumns({**emptied, **checked, "refused": told & ~passed, "failure_reason": F.when(demoted, "not approved by eye").otherwise(F.lit(""))})
    return out.withColumn("status", F.when(told, "confirmed").when(demoted, "review_required").otherwise(F.col("status"))).drop("_approved", *audit_columns)


def hydrate(matches: DataFrame, details: DataFrame, least: int) -> DataFrame:
    """M-11: matched records that miss an image get that of their page, if they are still safe; unsafe ones go to review.

    matches: (id, code, status, score, safe, image_url); details: (code, page_image), one row a code.
    """
    joined = matches.join(details, "code", "left")
    open_ones = F.col("status") == "image_missing"
    safe = F.coalesce("safe", F.lit(False)) & (F.col("score") >= least)
    found = open_ones & safe & (blank(F.col("page_image")) != "")
    return joined.select(
        "id",
        "code",
        F.when(open_ones & ~safe, "review_required").when(found, "confirmed").otherwise(F.col("status")).alias("status"),
        F.when(found, F.col("page_image")).otherwise(F.col("image_url")).alias("image_url"),
    )


def full_key(name: Column, specification: Column) -> Column:
    """D-14."""
    return full_name(F.concat(blank(name), blank(specification)))


def verified_details(requests: DataFrame, pages: DataFrame, payloads: DataFrame) -> DataFrame:
    """P-16: requests (id, code, name, capacity) with their page (code, page_code, endpoint_code) and payload (code, payload_code, drug_name).

    A record is collected if page, endpoint and payload name the requested code, and the payload's name is safe for the
    requested one; else it goes to review with the first reason. Needs `score` and `safe` beforehand (names.judged).
    """
    joined = requests.join(pages, "code", "left").join(payloads, "code", "left")
    same = lambda c: F.coalesce(F.col(c) == F.col("code"), F.lit(False))
    reason = (
        F.when(F.col("payload_code").isNull(), "empty_payload")
        .when(~(same("page_code") & same("endpoint_code") & same("payload_code")), "code_differs")
        .when(F.col("score") < 96, "name_differs")
        .when(~F.coalesce("safe", F.lit(False)), "unsafe_name")
        .otherwise("")
    )
    return joined.select("id", "code", F.when(reason == "", F.col("drug_name")).otherwise(F.col("name")).alias("official_name"), F.when(reason == "", "collected").otherwise("review_required").alias("status"), reason.alias("error"))


def identity(x: Column) -> Column:
    """The part of a name that two texts must share to be one drug."""
    return name_facts(x)["identity"]
