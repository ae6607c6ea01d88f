"""Canonical names, brands and chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conflicts(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value: key, n."""
    return pairs.groupBy(key).agg(F.count_distinct(value).alias("n")).where("n > 1")


def classified(names: DataFrame, aliases: DataFrame, co_brands: DataFrame, brands: DataFrame, name: str = "name") -> DataFrame:
    """Adds canonical_name, brand_candidates, fast_food_brands, is_co_brand to rows with a normalised name.

    aliases: alias, brand. co_brands: location, brand, place (order). brands: brand. These are reviewed
    lists; Spark decides by their size whether to broadcast them. A null or empty name has no candidates."""
    several = co_brands.groupBy(F.col("location").alias("__name")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "brand"))), lambda x: x["brand"]).alias("__brands"))
    known = brands.select(F.col("brand").alias("__known")).distinct()
    # a name decides everything, so the work is done once for each distinct name
    each = names.select(F.col(name).alias("__name")).where("__name IS NOT NULL").distinct()
    each = each.join(aliases.select(F.col("alias").alias("__name"), F.col("brand").alias("__brand")).distinct(), "__name", "left").join(several, "__name", "left")
    each = each.withColumn("canonical_name", F.coalesce("__brand", "__name"))
    nothing = F.array().cast("array<string>")
    each = each.withColumn("brand_candidates", F.coalesce("__brands", F.when(F.col("canonical_name") == "", nothing).otherwise(F.array("canonical_name"))))
    hits = each.select("__name", F.posexplode("brand_candidates").alias("__at", "__known")).join(known, "__known")
    hits = hits.groupBy("__name").agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__known"))), lambda x: x["__known"]).alias("fast_food_brands"))
    each = each.join(hits, "__name", "left").select("__name", "canonical_name", "brand_candidates", "fast_food_brands")
    out = names.join(each, F.col(name) == F.col("__name"), "left").drop("__name")
    out = out.withColumns({c: F.coalesce(c, nothing) for c in ("brand_candidates", "fast_food_brands")})
    return out.withColumn("is_co_brand", F.size("brand_candidates") > 1)


def overridden(brands: DataFrame, overrides: DataFrame) -> DataFrame:
    """brand: the list with reviewed INCLUDE rows added and EXCLUDE rows taken out. overrides: brand, action. Two actions for a brand are an error."""
    if conflicts(overrides, "brand", "action").limit(1).count():
        raise ValueError("a brand has conflicting overrides")
    kept = brands.select("brand").join(overrides.where("action = 'EXCLUDE'"), "brand", "left_anti")
    return kept.unionByName(overrides.where("action = 'INCLUDE'").select("brand")).distinct()


def contained_brands(names: DataFrame, brands: DataFrame, name: str = "name") -> DataFrame:
    """name, brands: the longest known brands that stand in a name as whole words.

    A brand starts at some word of the name, so runs of words are looked up as equi-joins, up to the
    longest brand's number of words; no pair of name and brand is formed that doesn't match."""
    most = brands.agg(F.coalesce(F.max(F.size(F.split("brand", " "))), F.lit(0))).first()[0]
    words = names.select(name).distinct().withColumn("__w", F.split(name, " "))
    runs = words.select(name, F.posexplode("__w").alias("__at", "__x"), "__w").withColumn("__n", F.explode(F.sequence(F.lit(1), F.lit(max(1, most)))))
    runs = runs.where(F.col("__at") + F.col("__n") <= F.size("__w")).select(name, F.array_join(F.slice("__w", F.col("__at") + 1, F.col("__n")), " ").alias("brand")).distinct()
    hits = runs.join(brands.select("brand").distinct(), "brand").groupBy(name).agg(F.array_sort(F.collect_list("brand")).alias("all"))
    inside = lambda a, b: (a != b) & F.contains(F.concat(F.lit(" "), b, F.lit(" ")), F.concat(F.lit(" "), a, F.lit(" ")))
    return hits.select(name, F.filter("all", lambda a: ~F.exists("all", lambda b: inside(a, b))).alias("brands"))


def chains(places: DataFrame, key: str = "place_key", name: str = "name", group: str = "cuisine", co_brand: str = "is_co_brand", least: int = 3, shortest: int = 5, extra_words: int = 2) -> DataFrame:
    """Adds family_name, match_method, location_count, is_chain, chain_key, chain_name.

    A name at `least` places or more is an anchor. A place whose name begins with an anchor of the same
    group and `extra_words` words more at most belongs to the longest such anchor. Anchors are looked up
    by the name's own leading words, an equi-join, so a hot group isn't paired with all its anchors."""
    counts = places.where(F.col(name).isNotNull()).groupBy(name).agg(F.count_distinct(key).alias("__same"))
    anchors = places.join(counts.where(F.col("__same") >= least), name).where(F.length(name) >= shortest).select(F.col(name).alias("__anchor"), F.col(group).alias("__group")).distinct()
    words = F.split(name, " ")
    cuts = places.where(~F.col(co_brand)).select(key, F.col(group).alias("__group"), words.alias("__w")).withColumn("__n", F.explode(F.sequence(F.lit(1), F.lit(extra_words))))
    cuts = cuts.where(F.size("__w") > F.col("__n")).select(key, "__group", F.array_join(F.slice("__w", 1, F.size("__w") - F.col("__n")), " ").alias("__anchor"))
    best = cuts.join(anchors, ["__group", "__anchor"]).groupBy(key).agg(F.min(F.struct((-F.length("__anchor")).alias("__short"), "__anchor")).alias("__best"))
    joined = places.join(best.select(key, F.col("__best.__anchor").alias("__variant")), key, "left").join(counts, name, "left")
    method = F.when(F.col("__same") >= least, "EXACT_NAME").when(F.col("__variant").isNotNull(), "AUTO_PREFIX").otherwise("UNMATCHED")
    family = joined.withColumn("family_name", F.coalesce("__variant", name)).withColumn("match_method", method).drop("__variant", "__same")
    sizes = family.where("family_name IS NOT NULL").groupBy("family_name").agg(F.count_distinct(key).alias("location_count"))
    out = family.join(sizes, "family_name", "left").withColumn("location_count", F.coalesce("location_count", F.lit(1)))
    chain = F.col("location_count") >= least
    return (
        out.withColumn("is_chain", chain)
        .withColumn("chain_key", F.when(chain, F.sha2("family_name", 256)))
        .withColumn("chain_name", F.when(chain, F.col("family_name")))
        .withColumn("match_method", F.when(chain, F.col("match_method")).otherwise("UNMATCHED"))
        .withColumn("match_confidence", F.when(chain & F.col("match_method").isin("EXACT_NAME", "AUTO_PREFIX"), "HIGH").otherwise("NONE"))
    )


def name_profile(names: DataFrame, name: str = "name") -> DataFrame:
    """Groups of spellings that share a normal form: normal, spellings (sorted), n."""
    from millrace.functions.text import name_syntax

    grouped = names.select(name, name_syntax(F.col(name)).alias("normal")).groupBy("normal").agg(F.array_sort(F.collect_set(name)).alias("spellings"))
    return grouped.withColumn("n", F.size("spellings")).where("n > 1")
