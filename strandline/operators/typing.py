"""Sequence types: profiles(st, st_ord, locus, allele) matched against exact calls(sample, locus, allele)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.numbering import numbered_in_order


def match_profiles(samples: DataFrame, calls: DataFrame, profiles: DataFrame) -> DataFrame:
    """(sample, st): the first profile of which every locus agrees; null where there is none.

    Relational division by a join on (locus, allele) and a count. An allele N of a profile agrees
    with a sample that has no call at the locus. Ids with a prefix, as locus_7, agree with plain ones.
    """
    plain = lambda c: F.element_at(F.split(c, "_"), -1)
    p = profiles.select("st", "st_ord", "locus", plain(F.col("allele")).alias("allele"))
    called = calls.select("sample", "locus", plain(F.col("allele")).alias("allele")).filter("allele IS NOT NULL").distinct()
    type_ = ["st", "st_ord"]
    need = p.groupBy(*type_).agg(F.count("*").alias("need"), F.count_if(F.col("allele") == "N").alias("n_open"))
    met = called.join(p.filter("allele <> 'N'"), ["locus", "allele"]).groupBy("sample", *type_).agg(F.count("*").alias("met")).join(need, type_)
    # a call at an open locus speaks against a profile; sought only for the pairs that agree at another locus
    open_ = met.filter("n_open > 0").select("sample", *type_).join(p.filter("allele = 'N'").select(*type_, "locus"), type_)
    against = open_.join(called.select("sample", "locus").distinct(), ["sample", "locus"]).groupBy("sample", *type_).agg(F.count("*").alias("against"))
    whole = met.join(against, ["sample", *type_], "left").filter(F.col("met") + F.col("n_open") - F.coalesce("against", F.lit(0)) == F.col("need")).select("sample", *type_)
    # a profile of open loci only agrees with samples that have no call; the first such profile is one row
    bare = need.filter("need = n_open").agg(F.min(F.struct("st_ord", "st")).alias("p")).filter("p IS NOT NULL").select("p.st", "p.st_ord")
    silent = samples.select("sample").distinct().join(called.join(p.select("locus").distinct(), "locus", "left_semi"), "sample", "left_anti")
    whole = whole.unionByName(silent.join(F.broadcast(bare)))
    first = whole.groupBy("sample").agg(F.min_by("st", "st_ord").alias("st"))
    return samples.select("sample").distinct().join(first, "sample", "left")


def assign_types(samples: DataFrame, calls: DataFrame, profiles: DataFrame) -> DataFrame:
    """(sample, st, status): Known, New for a sample with all loci called, or Unknown ('-').

    New types are numbered on from the number of profiles, by first sample, with the suffix _INF.
    """
    matched = match_profiles(samples, calls, profiles)
    loci = profiles.select("locus").distinct()
    size = loci.agg(F.count("*").alias("n_loci"))
    rows = calls.join(loci, "locus", "left_semi").filter("allele IS NOT NULL").groupBy("sample").agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("locus", "allele")))).alias("profile"))
    rows = rows.crossJoin(F.broadcast(size)).filter(F.size("profile") == F.col("n_loci"))
    rows = rows.withColumn("key", F.to_json("profile")).join(matched.filter("st IS NULL").select("sample"), "sample", "left_semi")
    first = rows.groupBy("key").agg(F.min("sample").alias("first_sample"))
    known = profiles.select("st").distinct().agg(F.count("*").alias("n_known"))
    named = numbered_in_order(first, ["first_sample"], "k").crossJoin(F.broadcast(known)).select("key", F.concat((F.col("n_known") + F.col("k")).cast("string"), F.lit("_INF")).alias("new_st"))
    fresh = rows.join(named, "key").select("sample", "new_st")
    out = matched.join(fresh, "sample", "left")
    status = F.when(F.col("st").isNotNull(), F.when(F.endswith("st", F.lit("_INF")), "New").otherwise("Known")).when(F.col("new_st").isNotNull(), "New").otherwise("Unknown")
    return out.select("sample", F.coalesce("st", "new_st", F.lit("-")).alias("st"), status.alias("status"))


def type_rollup(types: DataFrame) -> DataFrame:
    """Counts by status and type, with the totals of each level."""
    return types.rollup("status", "st").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def updated_profiles(profiles: DataFrame, types: DataFrame, calls: DataFrame) -> DataFrame:
    """The next version of the profiles: with a row per locus of each new type."""
    last = profiles.agg(F.max("st_ord").alias("last"))
    new = types.filter("status = 'New'").join(profiles.select("st").distinct(), "st", "left_anti").groupBy("st").agg(F.min("sample").alias("sample"))
    new = new.withColumn("at", F.split("st", "_")[0].cast("int"))
    rows = numbered_in_order(new, ["at"], "k").crossJoin(F.broadcast(last)).join(calls.select("sample", "locus", "allele"), "sample")
    return profiles.unionByName(rows.select("st", (F.col("last") + F.col("k")).cast(profiles.schema["st_ord"].dataType).alias("st_ord"), "locus", "allele"))
