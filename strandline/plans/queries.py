"""The catalogue: one query for each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import sequence as seqf
from strandline.operators import align, calling, distance, genes, hits, pieces, representatives, schema, snps, typing
from strandline.plans import surrogates as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE_RULE = distance.MissingFilter(sample_threshold=10, locus_threshold=12)
HIT_ORDER = ["line_no", "part", "supp", "bitscore", "ship"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _by_doc(f: Callable[[Column], Column], name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return s.dna_alleles(spark, sf_dir).select(F.col("ord").alias("doc_id"), f(F.col("seq")).alias(name))

    return run


@query
def filtered_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.distance_matrix(s.event_calls(spark, sf_dir), SAMPLE_RULE)


@query
def hamming_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.hamming(s.event_calls(spark, sf_dir))


@query
def missing_sample_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.filter_samples(s.event_calls(spark, sf_dir), SAMPLE_RULE).select("sample", "locus", "tag")


@query
def missing_locus_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.filtered(s.event_calls(spark, sf_dir), SAMPLE_RULE).select("sample", "locus", "tag")


@query
def missing_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.filter_report(s.event_calls(spark, sf_dir), "sample", SAMPLE_RULE)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event calls under tags of every class."""
    names = {"click": "INF_l_1_0", "view": "7", "purchase": "NIPH", "signup": "ASM_l_2_0", "error": "PLOT_3"}
    tag = F.col("tag")
    out = tag
    for k, v in names.items():
        out = F.when(tag == k, v).otherwise(out)
    return s.event_calls(spark, sf_dir).withColumn("tag", F.when((F.col("sample") + F.col("locus")) % 11 == 0, F.lit("NIPHEM")).when((F.col("sample") + F.col("locus")) % 13 == 0, F.lit("ERROR not stop codon")).when((F.col("sample") + F.col("locus")) % 17 == 0, F.lit("abc_9")).otherwise(out))


@query
def tag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = calling.summary(_tagged(spark, sf_dir))
    return out.select("sample", *[F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in calling.SUMMARY_CLASSES])


@query
def tag_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = F.when(F.col("locus") % 3 == 0, "good_quality").when(F.col("locus") % 3 == 1, "bad_quality: no_start").otherwise("bad_quality: no_stop")
    return calling.tag_rollup(_tagged(spark, sf_dir), quality)


@query
def st_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "Known").when(F.col("o_orderstatus") == "O", "New").otherwise("Unknown")
    return typing.type_rollup(s.table(spark, sf_dir, "orders").select(status.alias("status"), F.col("o_orderpriority").alias("st")))


@query
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schema.length_stats(s.text_alleles(spark, sf_dir))
    return out.select("locus", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"), F.col("min_length").cast("long"), F.col("max_length").cast("long"), "total")


@query
def length_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.length_mode(s.text_alleles(spark, sf_dir)).select("locus", F.col("mode").cast("long").alias("mode"), "n")


@query
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.length_histogram(s.text_alleles(spark, sf_dir)).select("locus", F.col("len").cast("long").alias("len"), "n")


@query
def length_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = schema.length_stats(s.text_alleles(spark, sf_dir))
    sd = schema.length_thresholds(stats, "SD").select("locus", F.col("min_len").alias("sd_min"), F.col("max_len").alias("sd_max"))
    return schema.length_thresholds(stats, 20).join(sd, "locus")


@query
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.duplicate_groups(s.text_alleles(spark, sf_dir)).select("locus", F.array_join("ids", ",").alias("ids"))


@query
def subset_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.subset_pairs(s.text_alleles(spark, sf_dir))


@query
def schema_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.filter_schema(s.dna_alleles(spark, sf_dir), subsets=True, duplicates=True, non_coding=False).select("locus", "allele_id")


@query
def coding_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-coding rule on documents' DNA, that of even ids begun with a start codon and ended at its first stop."""
    a = s.dna_alleles(spark, sf_dir)
    whole = F.concat(F.lit("ATG"), F.substring("seq", F.lit(1), (seqf.first_stop(F.col("seq")) + 3).cast("int")))
    a = a.withColumn("seq", F.coalesce(F.when(F.col("ord") % 2 == 0, whole).otherwise(F.col("seq")), F.lit("")))
    return schema.filter_schema(a, non_coding=True).select("locus", "allele_id")


@query
def schema_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.schema_info(s.dna_alleles(spark, sf_dir)).select("locus", "allele_id", "quality", "direction", "coding")


@query
def schema_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schema.summary(s.dna_alleles(spark, sf_dir))
    return out.select("locus", F.col("mode").cast("long").alias("mode"), F.round("variability", 6).alias("variability"), F.round("non_coding_percent", 6).alias("non_coding_percent"), F.round("protein_ratio", 6).alias("protein_ratio"))


QUERIES["reverse_complement"] = _by_doc(seqf.reverse_complement, "rc")
QUERIES["seq_direction"] = _by_doc(seqf.direction, "direction")
QUERIES["stop_codon"] = _by_doc(lambda c: seqf.first_stop(c).cast("long"), "first_stop")
QUERIES["allele_quality"] = _by_doc(seqf.quality_class, "quality")
QUERIES["translate_protein"] = _by_doc(seqf.translate, "protein")
QUERIES["cds_check"] = _by_doc(seqf.coding_protein, "protein")


@query
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.quality_counts(s.dna_alleles(spark, sf_dir))


def _with_next(a: DataFrame, parts: int = 64) -> DataFrame:
    """alleles with found, the sequence of the next ord in the locus.

    Only ids are ordered: in ranges of ord within each locus, then the ranges' first ids. Sequences
    move by equi-joins, so a language with most documents is no single task.
    """
    ids = a.select("locus", "ord")
    cuts = sorted(set(ids.approxQuantile("ord", [i / parts for i in range(1, parts)], 0.001)))
    range_ = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("ord"))) if cuts else F.lit(0)
    ids = ids.withColumn("range", range_)
    heads = ids.groupBy("locus", "range").agg(F.min("ord").alias("head"))
    heads = heads.withColumn("next_head", F.lead("head").over(Window.partitionBy("locus").orderBy("range"))).drop("head")  # at most `parts` rows a locus
    ids = ids.withColumn("next", F.lead("ord").over(Window.partitionBy("locus", "range").orderBy("ord"))).join(heads, ["locus", "range"])
    ids = ids.select("locus", "ord", F.coalesce("next", "next_head").alias("next")).filter("next IS NOT NULL")
    following = a.select("locus", F.col("ord").alias("next"), F.col("seq").alias("found")).filter("found IS NOT NULL")
    return a.join(ids, ["locus", "ord"]).join(following, ["locus", "next"])


@query
def snp_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's DNA against that of the next one in its language."""
    a = s.dna_alleles(spark, sf_dir)
    out = snps.snps(_with_next(a).select(F.col("ord").alias("doc_id"), F.col("seq").alias("allele_seq"), F.col("found").alias("found_seq")))
    return out.withColumn("position", F.col("position").cast("long"))


@query
def best_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = s.item_hits(spark, sf_dir)
    return hits.best(h, ["sample"], [F.col(c) for c in HIT_ORDER]).select("sample", "contig", "bitscore", "line_no")


@query
def best_hit_in_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = s.item_hits(spark, sf_dir).filter(hits.in_band(F.col("hit_end") - F.col("hit_start"), F.lit(10), F.lit(30)))
    return hits.best(h, ["sample"], [F.col(c) for c in HIT_ORDER]).select("sample", "contig", "bitscore", "line_no")


@query
def top_k_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("bitscore"), *[F.col(c) for c in HIT_ORDER]]
    return hits.top_hits(s.item_hits(spark, sf_dir), ["sample"], "contig", order, max_targets=2, max_hsps=2).select("sample", "contig", "bitscore", "line_no")


@query
def overlap_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hits.overlap_dedupe(s.item_hits(spark, sf_dir), ["sample"], HIT_ORDER, "contig", "hit_start", "hit_end")
    return out.select("sample", "contig", "line_no", "hit_start", "hit_end", "bitscore")


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, item_id, passage, at): benchmark passages in documents, of any length and at any place."""
    d, b = s.table(spark, sf_dir, "documents").select("doc_id", "text"), s.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"))
    texts = d.select(F.lit("all").alias("locus"), F.concat(F.lit("d"), F.col("doc_id")).alias("allele_id"), F.col("text").alias("seq"))
    items = b.select(F.lit("all").alias("locus"), F.concat(F.lit("i"), F.col("item_id")).alias("allele_id"), F.col("passage").alias("seq"))
    met = schema.contained_in(items, texts).select(F.substr("container", F.lit(2)).cast("long").alias("doc_id"), F.substr("contained", F.lit(2)).cast("long").alias("item_id"))
    return met.join(d, "doc_id").join(b, "item_id").withColumn("at", hits.located(F.col("text"), F.col("passage"))).select("doc_id", "text", "item_id", "passage", "at")


@query
def hit_relocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _passages(spark, sf_dir)
    return p.select("doc_id", "item_id", F.col("at").cast("long").alias("hit_start"), (F.col("at") + F.length(seqf.ungapped(F.col("passage"))) - 1).cast("long").alias("hit_end"))


@query
def flank_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _passages(spark, sf_dir)
    return p.select("doc_id", "item_id", hits.flank(F.col("text"), F.col("at"), F.col("at") + F.length("passage") - 1, 20).alias("flanked"))


@query
def contig_edge_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = s.item_hits(spark, sf_dir)
    edge = hits.on_contig_edge(F.col("hit_start"), F.col("hit_end"), F.lit(365))
    return h.select("sample", "line_no", "part", "supp", "bitscore", edge.alias("edge"), (edge & (F.col("hit_end") - F.col("hit_start") < 25)).alias("plot"))


@query
def call_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision list on facts made from the line items of each order."""
    h = s.item_hits(spark, sf_dir)
    size = F.col("hit_end") - F.col("hit_start")
    facts = h.groupBy("sample").agg(
        F.count_if(F.col("contig") != 0).alias("n_first"), F.max(F.when(F.col("contig") == 0, F.col("line_no"))).alias("fb"), F.count_if(F.col("contig") == 1).alias("n_second"),
        (F.max("hit_end") > 380).alias("perfect"), F.count_if(size > 45).alias("n_seeds"), F.count_if(size > 25).alias("n_kept"), (F.max(size) > 20).alias("covered"), (F.min("hit_start") < 20).alias("on_edge"), F.max("hit_start").alias("last"), F.sum(size).alias("total"),
    )
    facts = facts.select("*", F.when(F.col("fb") > 2, F.col("fb").cast("string")).alias("fallback_allele"), (F.col("on_edge") & (F.col("last") < 100)).alias("plot"), F.when(F.col("total") % 7 != 0, F.col("total")).alias("final_len"), F.lit(30).alias("min_len"), F.lit(60).alias("max_len"), F.lit(10).alias("min_cov"), F.lit(120).alias("max_cov"))
    return calling.decide(facts).select("sample", "kind")


@query
def inferred_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as calls: brand the locus, type the new sequence, container of samples the part key."""
    p = s.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sample"), F.col("p_brand").alias("locus"), F.when(F.col("p_size") % 2 == 0, "INF").otherwise("ASM").alias("kind"), F.col("p_type").alias("final_seq"))
    return calling.numbered(p).select("sample", "locus", "kind", F.col("idx").cast("long").alias("idx"))


@query
def new_allele_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct long texts of documents with an odd id as inferred alleles of a schema of the even ones."""
    a = s.dna_alleles(spark, sf_dir).withColumn("description", F.lit(""))
    calls = a.filter("ord % 2 = 1").select("locus", F.lit("INF").alias("kind"), F.col("seq").alias("final_seq"), F.col("ord").alias("sample"))
    return calling.new_alleles(calling.numbered(calls), a.filter("ord % 2 = 0")).select("locus", "allele_id", F.col("seq").alias("seq"))


@query
def profile_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = s.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sample"))
    return typing.match_profiles(samples, s.part_calls(spark, sf_dir), s.part_profiles(spark, sf_dir))


@query
def type_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles are known whose first part costs less than the mean, so that types are known, new and unknown."""
    samples = s.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sample"))
    part = s.table(spark, sf_dir, "part")
    mean = part.agg(F.avg("p_retailprice").alias("mean"))
    cheap = part.crossJoin(F.broadcast(mean)).filter("p_retailprice < mean").select(F.col("p_partkey").alias("st_ord"))
    return typing.assign_types(samples, s.part_calls(spark, sf_dir), s.part_profiles(spark, sf_dir).join(cheap, "st_ord", "left_semi"))


def _source_dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The DNA of the whole texts of each source, source the locus."""
    d = s.table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("locus"), F.col("doc_id").cast("string").alias("allele_id"), s.dna(F.col("text")).alias("seq"), F.col("doc_id").alias("ord"))


@query
def kmer_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return representatives.word_distances(_source_dna(spark, sf_dir)).withColumn("distance", F.round("distance", 6))


@query
def sketch_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances by sketches of 400 hashes of the documents of a source that share one."""
    return representatives.sketch_distances(_source_dna(spark, sf_dir), size=400).withColumn("distance", F.round("distance", 6))


@query
def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _source_dna(spark, sf_dir)
    d = representatives.near_distances(a).withColumn("distance", F.round("distance", 6).cast("decimal(18,6)"))
    return representatives.centroids_of_near(d, a).select("locus", "allele_id", "good")


@query
def unrepresented(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _source_dna(spark, sf_dir)
    hit = representatives.near_distances(a).filter("distance < 0.1 AND id_1 < id_2").select("locus", F.col("id_2").alias("allele_id"))
    return representatives.unrepresented(a, hit).select("locus", "allele_id")


@query
def local_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's DNA with that of the next one in its language."""
    a = s.dna_alleles(spark, sf_dir)
    return align.local_alignments(_with_next(a).select(F.col("ord").alias("id"), F.col("seq").alias("a"), F.col("found").alias("b")))


@query
def similarity_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DNA of the benchmark's passages searched in the DNA of whole documents, as alleles in contigs."""
    letters = lambda c: F.translate(F.upper(F.regexp_replace(c, "[^A-Za-z]", "")), s.LETTERS, s.BASES)
    b = s.table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("locus"), F.col("item_id").cast("string").alias("allele_id"), letters(F.col("text")).alias("seq"))
    d = s.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sample"), F.lit("1").alias("contig"), letters(F.col("text")).alias("seq"))
    return align.similarity_join(b, d).select("sample", "qseqid", "pident", "length", "sstart", "send", "bitscore")


def _scored_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as hits whose identity falls with the discount and whose e-value rises with the tax."""
    l = s.table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.select(F.col("l_orderkey").alias("sample"), F.col("l_linenumber").cast("long").alias("line_no"), F.round(100 - F.col("l_discount") * 100, 2).cast("double").alias("pident"), F.round(F.col("l_tax") / 10, 4).cast("double").alias("evalue"), F.col("l_quantity").cast("long").alias("length"))


@query
def significant_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.significant(_scored_hits(spark, sf_dir), evalue=0.005, identity=95)


@query
def perfect_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _scored_hits(spark, sf_dir)
    return h.select("sample", "line_no", "pident", "length", hits.is_perfect(F.col("line_no") + 20).alias("perfect"))


@query
def predicted_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as hits, returned ones as predicted genes."""
    h = s.item_hits(spark, sf_dir).select("sample", "contig", "line_no", F.col("hit_start").alias("cstart"), F.col("hit_end").alias("cend"))
    l = s.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")  # noqa: E741
    start = F.dayofyear("l_shipdate").cast("long")
    genes = l.select(F.col("l_orderkey").alias("sample"), (F.col("l_suppkey") % 3).alias("contig"), start.alias("gene_start"), (start + F.col("l_quantity").cast("long")).alias("gene_end"), F.col("l_partkey").cast("string").alias("gene_seq"))
    return hits.predicted_gene(h, genes)


@query
def gene_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's DNA as a contig with genes of 900 letters end to end; a hit of 300 for each, from 700 letters into it.

    Every other gene is predicted with each fifth letter an A: the hit overlaps it more, but aligns better with the next.
    """
    a = s.dna_alleles(spark, sf_dir).filter("seq <> ''").select(F.lit("documents").alias("sample"), F.col("allele_id").alias("contig"), "seq")
    tile = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / 900).cast("int"))).alias("k")
    part = lambda first, n: F.substring("seq", first, F.lit(n))
    start = (F.col("k") * 900 + 1).cast("int")
    tiles = a.select("sample", "contig", "seq", tile)
    own = part(start, 900)
    changed = F.when(F.col("k") % 2 == 0, F.regexp_replace(own, "(.{4}).", "$1A")).otherwise(own)
    predicted = tiles.select("sample", "contig", start.alias("gene_start"), (start + F.length(own) - 1).alias("gene_end"), changed.alias("gene_seq"))
    h = tiles.select("sample", "contig", (start + 700).alias("cstart"), part(start + 700, 300).alias("sseq"), F.length("seq").alias("size")).filter("cstart <= size")
    h = h.select("sample", "contig", "cstart", (F.col("cstart") + F.length("sseq") - 1).alias("cend"), "sseq")
    return genes.best_gene(h, predicted).select(F.col("contig").cast("long").alias("doc_id"), "cstart", "cend", "predicted_start", "predicted_end", "predicted_seq")


@query
def final_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's DNA as a contig, with a hit forward from a third of it for English, else back from its middle."""
    size = F.length("seq")
    forward = F.col("locus") == "en"
    start = F.when(forward, F.floor(size / 3)).otherwise(F.floor(size / 2)).cast("int") + 1
    found = seqf.final_sequence(F.col("seq"), start, F.when(forward, size).otherwise(0))
    return s.dna_alleles(spark, sf_dir).select(F.col("ord").alias("doc_id"), found.alias("found"))


@query
def final_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's DNA as a contig with a hit from a third to the middle of it: back for every other two documents, its allele stored in reverse for every other one."""
    a = s.dna_alleles(spark, sf_dir)
    contigs = a.select(F.col("ord").alias("sample"), F.lit("1").alias("contig"), "seq")
    size, back = F.length("seq"), F.floor(F.col("ord") / 2) % 2 == 1
    low, high = (F.floor(size / 3) + 1).cast("int"), (F.floor(size / 2) + 1).cast("int")
    placed = a.select(F.col("ord").alias("sample"), F.lit("1").alias("contig"), F.when(back, high).otherwise(low).alias("cstart"), F.when(back, low).otherwise(high).alias("cend"), (F.col("ord") % 2 == 1).alias("turned"))
    return pieces.final_sequences(placed, contigs).select(F.col("sample").alias("doc_id"), "final_seq", F.col("final_len").cast("long").alias("final_len"))


@query
def contig_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names out of subject ids, of two parts for English documents, else of four."""
    d = s.table(spark, sf_dir, "documents")
    id_ = F.col("doc_id").cast("string")
    subject = F.when(F.col("lang") == "en", F.concat_ws("|", "source", id_)).otherwise(F.concat_ws("|", F.lit("gnl"), "lang", "source", id_))
    return d.select("doc_id", seqf.contig_name(subject).alias("contig"))


@query
def mutation_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as calls: the size the found length, 25 the allele's, those below 1000 ASM."""
    kind = F.when(F.col("p_retailprice") < 1000, "ASM").otherwise("ALM")
    return s.table(spark, sf_dir, "part").select("p_partkey", seqf.mutation_effect(F.col("p_size"), F.lit(25), kind).alias("info"))


KINDS = ["LNF", "LNF_LOW_ID", "LNF_LOW_COVERAGE", "EXACT", "NIPH", "NIPHEM", "PLOT", "TPR", "ERROR", "INF", "ASM", "ALM"]


@query
def tag_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as calls: the kind by their size, brand the locus, the key the allele."""
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("p_size") % 12 + 1).cast("int"))
    return s.table(spark, sf_dir, "part").select("p_partkey", calling.tag_text(kind, F.col("p_brand"), F.col("p_partkey").cast("string"), F.col("p_size")).alias("tag"))
