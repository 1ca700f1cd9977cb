"""Allele calls: one tag for every sample and locus, by an explicit decision list over hit tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import sequence as seqf
from strandline.functions.alignment import Scoring
from strandline.operators import hits as hitsf
from strandline.operators.align import Search, local_alignments, query_words, similarity_join
from strandline.operators.genes import best_gene
from strandline.operators.numbering import numbered_within
from strandline.operators.pieces import final_sequences
from strandline.operators.schema import length_stats
from strandline.operators.snps import snps
from strandline.storage import durable


@dataclass(frozen=True)
class CallConfig:
    """Parameters of a calling run; percent_length 'SD' widens a locus by its deviation times its mean."""

    percent_length: float | str = "SD"
    coverage: float = 50
    identity_ref: float = 85
    identity_locus: float = 90
    identity_fallback: float = 70
    evalue: float = 0.001
    max_targets: int = 10
    max_hsps: int = 10
    flank: int = 100
    reward: int = 1
    penalty: int = -2
    gap_open: int = 1
    gap_extend: int = 1

    @property
    def search_scoring(self) -> Scoring:
        return Scoring(self.reward, self.penalty, self.gap_open, self.gap_extend)

    @property
    def call_scoring(self) -> Scoring:
        """Scores of the alignments reported with calls."""
        return Scoring(self.reward, self.penalty, self.gap_open, self.gap_extend, opens_first=True)


#: Ungapped score that a region of the weak search needs, whose words of 11 letters also meet by chance.
WEAK_TRIGGER = 16


def thresholds(alleles: DataFrame, config: CallConfig = CallConfig()) -> DataFrame:
    """(locus, locus_mean, min_len, max_len, min_cov, max_cov)."""
    m = F.col("mean").cast("int")

    def band(p: float | str) -> tuple[Column, Column]:
        spread = m * F.col("stdev") if p == "SD" else m * (float(p) / 100)
        return F.floor(m - spread).cast("long"), F.ceil(m + spread).cast("long")

    (lo, hi), (clo, chi) = band(config.percent_length), band(config.coverage)
    return length_stats(alleles).select("locus", m.alias("locus_mean"), lo.alias("min_len"), hi.alias("max_len"), clo.alias("min_cov"), chi.alias("max_cov"))


def spine(samples: DataFrame, loci: DataFrame) -> DataFrame:
    """Every sample with every locus: the cells of the matrix, which is the answer's size."""
    return samples.select("sample").distinct().crossJoin(loci.select("locus").distinct())


def decide(facts: DataFrame) -> DataFrame:
    """facts with the call's kind by the decision list, in order.

    Needs n_first, fallback_allele, n_second, perfect, n_seeds, n_kept, covered, on_edge, plot,
    final_len, min_len, max_len, min_cov, max_cov.
    """
    c = F.col
    kind = (
        F.when((c("n_first") == 0) & c("fallback_allele").isNull(), "LNF")
        .when(c("n_first") == 0, "LNF_LOW_ID")
        .when(c("n_second") == 0, "LNF")
        .when(c("perfect") & (c("n_seeds") > 1), "NIPHEM")
        .when(c("perfect") & (c("n_kept") > 1), "NIPH")
        .when(c("perfect"), "EXACT")
        .when(~c("covered") & ~c("on_edge"), "LNF_LOW_COVERAGE")
        .when(c("n_kept") > 1, "NIPH")
        .when(c("plot"), "PLOT")
        .when(c("final_len").isNull(), "ERROR")
        .when(c("final_len").between(c("min_len"), c("max_len")), "INF")
        .when((c("final_len") >= c("min_cov")) & (c("final_len") < c("min_len")), "ASM")
        .when((c("final_len") > c("max_len")) & (c("final_len") <= c("max_cov")), "ALM")
        .otherwise("TPR")
    )
    return facts.withColumn("kind", kind)


def numbered(calls: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """calls with idx: for INF, ASM and ALM the order in which a locus first shows a new sequence, over samples in order.

    A sequence of the registry(locus, kind, final_seq, idx) keeps its number there; others are
    numbered on from the registry's greatest.
    """
    key = ["locus", "kind", "final_seq"]
    first = calls.filter(F.col("kind").isin("INF", "ASM", "ALM")).groupBy(*key).agg(F.min("sample").alias("first_sample"))

    def ranked(rows: DataFrame, name: str) -> DataFrame:
        """In order of the sequences' first samples; of those with one sample and the same beginning a task takes all."""
        placed = numbered_within(rows, ["locus", "kind"], ["first_sample", "final_seq"], "place", ["first_sample", F.substring("final_seq", 1, 32)])
        return placed.withColumn(name, (F.col("place") - 1).cast("int")).drop("place")

    if registry is None:
        return calls.join(ranked(first, "idx").select(*key, "idx"), key, "left")
    known = first.join(registry, key).select(*key, "idx")
    fresh = ranked(first.join(registry, key, "left_anti"), "rank")
    after = registry.groupBy("locus", "kind").agg((F.max("idx") + 1).alias("after"))
    fresh = fresh.join(after, ["locus", "kind"], "left").select(*key, (F.coalesce("after", F.lit(0)) + F.col("rank")).cast("int").alias("idx"))
    return calls.join(known.unionByName(fresh), key, "left")


def tag_text(kind: Column, locus: Column, allele: Column, idx: Column) -> Column:
    return (
        F.when(kind == "LNF", "LNF")
        .when(kind.isin("LNF_LOW_ID", "LNF_LOW_COVERAGE"), F.concat(F.lit("LNF_"), allele))
        .when(kind == "EXACT", allele)
        .when(kind.isin("NIPH", "NIPHEM"), kind)
        .when(kind.isin("PLOT", "TPR"), F.concat(kind, F.lit("_"), allele))
        .when(kind == "ERROR", "ERROR not stop codon")
        .otherwise(F.concat(kind, F.lit("_"), locus, F.lit("_"), allele, F.lit("_"), idx.cast("string")))
    )


def calls_from_hits(samples: DataFrame, alleles: DataFrame, contigs: DataFrame, first: DataFrame, second: DataFrame, fallback: DataFrame, config: CallConfig = CallConfig(), registry: DataFrame | None = None) -> DataFrame:
    """One row for each sample and locus, with its tag and the hit it rests on.

    first, second and fallback are hits (sample, locus, line_no, contig, HIT_FIELDS): of reference
    alleles in the contigs, of all alleles in what those found, and the best at a lower identity.
    """
    limits = thresholds(alleles, config)
    sizes = alleles.select("locus", F.col("allele_id").alias("qseqid"), F.length("seq").alias("allele_len"), (seqf.direction(F.col("seq")) == "reverse").alias("turned"))
    found = second.join(sizes, ["locus", "qseqid"]).join(limits, "locus").join(contigs.select("sample", "contig", F.col("seq").alias("contig_seq")), ["sample", "contig"])
    found = hitsf.relocate(found, F.col("contig_seq")).filter("cstart IS NOT NULL")
    size = F.length(seqf.ungapped(F.col("sseq")))
    found = found.withColumns({
        "found_len": size,
        "is_perfect": hitsf.is_perfect(F.col("allele_len")),
        "in_length": hitsf.in_band(size, F.col("min_len"), F.col("max_len")),
        "in_cover": hitsf.in_band(size, F.col("min_cov"), F.col("max_cov")),
        "edge": hitsf.on_contig_edge(F.col("cstart"), F.col("cend"), F.length("contig_seq")),
    })
    row = F.struct(F.col("line_no").alias("o"), "contig", "cstart", "cend", "qseqid", "pident", "length", "mismatch", "gapopen", "bitscore", "sseq", "allele_len", "found_len", "is_perfect", "in_length", "in_cover", "edge", "turned")
    per = found.groupBy("sample", "locus").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    ranked = F.array_sort("rows", lambda a, b: F.when(a["bitscore"] != b["bitscore"], F.when(a["bitscore"] > b["bitscore"], -1).otherwise(1)).otherwise(F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)))
    per = per.withColumn("perfect_rows", F.filter("rows", lambda r: r["is_perfect"])).withColumn("ranked", ranked)
    per = per.withColumn("covered_row", F.get(F.filter("ranked", lambda r: r["in_cover"]), F.lit(0)))
    per = per.withColumn("best", F.coalesce("covered_row", F.get("ranked", F.lit(0))))
    per = per.withColumn("seeds", F.when(F.size("perfect_rows") > 0, hitsf.without_overlaps(F.col("perfect_rows"))).otherwise(F.array("best")))
    per = per.withColumn("kept", hitsf.without_overlaps(F.concat("seeds", F.filter("rows", lambda r: r["in_length"]))))
    per = per.withColumn("hit", F.when(F.size("perfect_rows") > 0, F.get("seeds", F.lit(0))).otherwise(F.col("best")))
    facts = per.select("sample", "locus", F.lit(1).alias("n_second"), (F.size("perfect_rows") > 0).alias("perfect"), F.size("seeds").alias("n_seeds"), F.size("kept").alias("n_kept"), F.col("covered_row").isNotNull().alias("covered"), F.col("hit.edge").alias("on_edge"), (F.col("hit.edge") & (F.col("hit.length") < F.col("hit.allele_len"))).alias("plot"), "hit", "kept")
    facts = durable(facts, "facts")
    # only what may become INF, ASM, ALM or TPR is read to its stop codon
    open_ = facts.filter("NOT perfect AND (covered OR on_edge) AND n_kept <= 1 AND NOT plot").select("sample", "locus", "hit.contig", "hit.cstart", "hit.cend", "hit.turned")
    finals = final_sequences(open_, contigs).select("sample", "locus", "final_seq", "final_len")
    facts = facts.join(finals, ["sample", "locus"], "left")

    n_first = first.groupBy("sample", "locus").agg(F.count("*").alias("n_first"))
    low = hitsf.best(fallback, ["sample", "locus"], [F.col("line_no")]).select("sample", "locus", F.col("qseqid").alias("fallback_allele"), F.col("pident").alias("fallback_pident"))
    cells = spine(samples, alleles).join(limits, "locus")
    cells = cells.join(n_first, ["sample", "locus"], "left").join(low, ["sample", "locus"], "left").join(facts, ["sample", "locus"], "left")
    cells = cells.fillna({"n_first": 0, "n_second": 0, "n_seeds": 0, "n_kept": 0}).withColumns({c: F.coalesce(c, F.lit(False)) for c in ("perfect", "covered", "on_edge", "plot")})
    calls = numbered(durable(decide(cells), "calls"), registry)
    allele = F.when(F.col("kind") == "LNF_LOW_ID", F.col("fallback_allele")).otherwise(F.col("hit.qseqid"))
    return calls.withColumn("allele", allele).withColumn("tag", tag_text(F.col("kind"), F.col("locus"), F.col("allele"), F.col("idx"))).drop("rows")


@dataclass(frozen=True)
class SchemaIndex:
    """The words of a schema for the three searches of a run: references, references by short words, all alleles within their locus."""

    first: DataFrame
    weak: DataFrame
    second: DataFrame


def _searches(config: CallConfig) -> tuple[Search, Search, Search]:
    common = {"evalue": config.evalue, "scoring": config.search_scoring}
    hits = {"max_targets": config.max_targets, "max_hsps": config.max_hsps}
    return (
        Search(identity=config.identity_ref, **hits, **common),
        Search(identity=config.identity_fallback, max_targets=1, max_hsps=1, word=11, stride=1, trigger=WEAK_TRIGGER, **common),
        Search(identity=config.identity_locus, **hits, **common),
    )


def schema_index(alleles: DataFrame, references: DataFrame, config: CallConfig = CallConfig()) -> SchemaIndex:
    """The index of a schema, which serves any number of runs; write its tables before where they are many."""
    first, weak, second = _searches(config)
    return SchemaIndex(query_words(references, first), query_words(references, weak), query_words(alleles, second, ["locus"]))


def call_alleles(alleles: DataFrame, references: DataFrame, contigs: DataFrame, config: CallConfig = CallConfig(), index: SchemaIndex | None = None, registry: DataFrame | None = None) -> DataFrame:
    """Calls from sequences: two native searches and a fallback, each written once to the shared folder, then the decision list.

    registry: the new sequences of earlier runs, with their numbers (numbered).
    """
    index = index or schema_index(alleles, references, config)
    limits, weak, inner = _searches(config)
    first = durable(similarity_join(references, contigs, limits, words=index.first), "first")
    tried = contigs.select("sample").distinct().crossJoin(references.select("locus").distinct())
    empty = tried.join(first.select("sample", "locus").distinct(), ["sample", "locus"], "left_anti")
    fallback = similarity_join(references.join(empty.select("locus").distinct(), "locus", "left_semi"), contigs.join(empty.select("sample").distinct(), "sample", "left_semi"), weak, words=index.weak)
    fallback = durable(fallback.join(empty, ["sample", "locus"], "left_semi"), "fallback")

    low, high = F.least("sstart", "send"), F.greatest("sstart", "send")
    around = first.join(contigs, ["sample", "contig"]).select("sample", "locus", "contig", hitsf.flank(F.col("seq"), low, high, config.flank).alias("seq")).distinct()
    number = F.row_number().over(Window.partitionBy("sample", "locus").orderBy("contig", "seq"))
    fragments = around.withColumn("fragment", F.concat(number.cast("string"), F.lit("_"), "contig"))
    second = similarity_join(alleles, fragments.select("sample", "locus", F.col("fragment").alias("contig"), "seq"), inner, on=["locus"], words=index.second)
    second = durable(second.withColumn("contig", F.regexp_replace("contig", r"^\d+_", "")), "second")
    return calls_from_hits(contigs.select("sample"), alleles, contigs, first, second, fallback, config, registry)


def summary_class(tag: Column) -> Column:
    """The summary column that a tag counts in, or null."""
    has = lambda s: F.contains(tag, F.lit(s))
    exact = tag.rlike(r"^[+-]?\d+$") | (has("_") & tag.rlike(r"\d$"))
    return (
        F.when(has("INF_"), "INF").when(has("ASM_"), "ASM").when(has("ALM_"), "ALM").when(has("LNF"), "LNF").when(has("TPR"), "TPR")
        .when(tag == "NIPH", "NIPH").when(tag == "NIPHEM", "NIPHEM").when(has("PLOT"), "PLOT").when(has("ERROR"), "ERROR").when(exact, "Exact match")
    )


# The columns of a summary, in order.
SUMMARY_CLASSES = ["Exact match", "INF", "ASM", "ALM", "LNF", "TPR", "NIPH", "NIPHEM", "PLOT", "ERROR"]


def summary(calls: DataFrame) -> DataFrame:
    """One row per sample: how many of its calls fall in each class."""
    kind = summary_class(F.col("tag"))
    return calls.groupBy("sample").agg(*[F.count_if(kind == k).alias(k) for k in SUMMARY_CLASSES])


def tag_rollup(calls: DataFrame, quality: Column) -> DataFrame:
    """Counts by sample, tag class, quality group and quality class, with the totals of each level."""
    rows = calls.select("sample", summary_class(F.col("tag")).alias("tag_class"), F.split(quality, ":")[0].alias("quality_group"), quality.alias("quality_class"))
    return rows.rollup("sample", "tag_class", "quality_group", "quality_class").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def new_alleles(calls: DataFrame, alleles: DataFrame) -> DataFrame:
    """Rows (locus, allele_id, seq, description, ord) for the inferred sequences, numbered on from the locus's greatest."""
    found = calls.filter("kind = 'INF'").select("locus", "idx", "final_seq").distinct()
    last = alleles.groupBy("locus").agg(F.max(seqf.allele_number(F.col("allele_id"))).alias("last"), F.max(F.contains("allele_id", F.lit("_"))).alias("prefixed"), F.max("ord").alias("last_ord"))
    rows = numbered_within(found, ["locus"], ["idx"], "k").join(F.broadcast(last), "locus")  # a row for each locus
    number = (F.coalesce("last", F.lit(0)) + F.col("k")).cast("string")
    return rows.select("locus", F.when(F.col("prefixed"), F.concat("locus", F.lit("_"), number)).otherwise(number).alias("allele_id"), F.col("final_seq").alias("seq"), F.lit("inferred").alias("description"), (F.col("last_ord") + F.col("k")).cast("int").alias("ord"))


def updated_schema(alleles: DataFrame, calls: DataFrame) -> DataFrame:
    """The next version of the schema: alleles and the inferred ones."""
    return alleles.unionByName(new_alleles(calls, alleles), allowMissingColumns=True)


def report(calls: DataFrame, kind: str, quality: DataFrame, annotation: DataFrame | None = None, genes: DataFrame | None = None, by_score: bool = False) -> DataFrame:
    """Rows of one report: exact, paralog, inferred, asm, alm, plot or lnf_tpr.

    quality(locus, allele_id, quality); annotation(locus, gene, product) fills the annotation columns.
    With genes(sample, contig, gene_start, gene_end, gene_seq) all but lnf_tpr get predicted_sequence:
    of the gene that overlaps the hit most or, by_score, of the one that aligns best with it; then
    exact, paralog and plot rows of alleles that are not of bad quality get '-', no gene is sought for them.
    """
    kinds = {"exact": ["EXACT"], "paralog": ["NIPH", "NIPHEM"], "inferred": ["INF"], "asm": ["ASM"], "alm": ["ALM"], "plot": ["PLOT"], "lnf_tpr": ["LNF", "LNF_LOW_ID", "LNF_LOW_COVERAGE", "TPR"]}[kind]
    rows = calls.filter(F.col("kind").isin(kinds))
    hit = F.explode("kept") if kind == "paralog" else F.col("hit")
    rows = rows.withColumn("h", hit).withColumn("allele", F.col("h.qseqid") if kind == "paralog" else F.col("allele"))
    rows = rows.join(quality.withColumnRenamed("allele_id", "allele"), ["locus", "allele"], "left")
    predicted = []
    if genes is not None and kind != "lnf_tpr":
        placed = rows.withColumns({"contig": F.col("h.contig"), "cstart": F.col("h.cstart"), "cend": F.col("h.cend")})
        if by_score:
            sought = F.lit(True) if kind in ("inferred", "asm", "alm") else F.coalesce(F.startswith("quality", F.lit("bad_quality")), F.lit(False))
            rows = best_gene(placed.withColumn("sseq", F.when(sought, F.col("h.sseq"))), genes).drop("sseq")
            rows = rows.withColumn("predicted_seq", F.when(sought, F.col("predicted_seq")).otherwise("-"))
        else:
            rows = hitsf.predicted_gene(placed, genes)
        rows = rows.drop("contig", "cstart", "cend", "predicted_start", "predicted_end")
        predicted = [F.col("predicted_seq").alias("predicted_sequence")]
    missing = F.lit("Not found")
    if annotation is not None:
        rows = rows.join(annotation, "locus", "left")
    else:
        rows = rows.withColumns({"gene": F.lit(None).cast("string"), "product": F.lit(None).cast("string")})
    base = [F.col("locus"), F.col("sample"), F.coalesce("gene", missing).alias("gene"), F.coalesce("product", missing).alias("product"), "tag", "allele", "quality"]
    place = [F.col("h.contig").alias("contig"), F.col("h.bitscore").alias("bitscore"), F.col("h.cstart").alias("contig_start"), F.col("h.cend").alias("contig_end")]
    found = seqf.ungapped(F.col("h.sseq"))
    if kind in ("exact", "plot"):
        return rows.select(*base, *place, F.col("h.length").alias("query_length"), found.alias("sequence"), *predicted)
    if kind == "paralog":
        return rows.select(*base, F.col("h.pident").alias("identity"), *place, found.alias("sequence"), *predicted)
    if kind == "lnf_tpr":
        blast = F.col("h.found_len") * 100.0 / F.col("locus_mean")
        new = F.col("final_len") * 100.0 / F.col("h.allele_len")
        side = lambda x: F.when(x < 100, "under").otherwise("above")
        info = (
            F.when(F.col("kind") == "LNF", "Locus not found").when(F.col("kind") == "LNF_LOW_ID", "identity under threshold")
            .when(F.col("kind") == "LNF_LOW_COVERAGE", F.concat(F.lit("hit coverage "), side(blast), F.lit(" threshold"))).otherwise(F.concat(F.lit("new sequence coverage "), side(new), F.lit(" threshold")))
        )
        return rows.select(*base, F.coalesce("fallback_pident", "h.pident").alias("identity"), blast.alias("hit_coverage"), new.alias("new_coverage"), F.col("h.allele_len").alias("query_length"), F.col("h.found_len").alias("contig_length"), F.col("final_len").alias("new_length"), info.alias("info"))
    more = [F.col("h.allele_len").alias("query_length"), F.col("h.found_len").alias("contig_length"), F.col("final_len").alias("new_length"), F.col("h.mismatch").alias("mismatch"), F.col("h.gapopen").alias("gaps"), F.col("final_seq").alias("new_sequence")]
    effect = [seqf.mutation_effect(F.col("h.found_len"), F.col("h.allele_len"), F.col("kind")).alias("info")] if kind in ("asm", "alm") else []
    return rows.select(*base, *place, *more, *effect, *predicted)


def matching_contigs(calls: DataFrame) -> DataFrame:
    """Where each call lies: (sample, contig, locus, allele, contig_start, contig_stop, direction, tag)."""
    one = F.when(F.col("kind").isin("NIPH", "NIPHEM"), F.col("kept")).otherwise(F.array("hit"))
    rows = calls.filter(F.col("kind").isin("EXACT", "NIPH", "NIPHEM", "INF", "ASM", "ALM", "PLOT", "ERROR")).withColumn("h", F.explode(one))
    back = F.col("h.cstart") > F.col("h.cend")
    size = F.when(F.col("kind") == "PLOT", F.lit(1)).otherwise(F.col("final_len"))
    moved = F.col("kind").isin("INF", "ASM", "ALM", "PLOT")
    start = F.when(moved & back, F.col("h.cstart") - size - 1).otherwise(F.col("h.cstart"))
    stop = F.when(moved & back, F.col("h.cstart")).when(moved, F.col("h.cstart") + size).otherwise(F.col("h.cend"))
    return rows.select("sample", F.col("h.contig").alias("contig"), "locus", F.col("h.qseqid").alias("allele"), start.alias("contig_start"), stop.alias("contig_stop"), F.when(back, "-").otherwise("+").alias("direction"), "tag")


def snp_rows(calls: DataFrame, alleles: DataFrame) -> DataFrame:
    """One row per difference between the found sequence and its allele, in the allele's own direction."""
    a = alleles.select("locus", F.col("allele_id").alias("allele"), F.col("seq").alias("allele_seq"))
    rows = calls.filter(F.col("kind").isin("INF", "ASM", "ALM")).join(a, ["locus", "allele"])
    turned = seqf.direction(F.col("allele_seq")) == "reverse"
    ours = F.when(turned, seqf.reverse_complement(F.col("allele_seq"))).otherwise(F.col("allele_seq"))
    found = seqf.ungapped(F.col("hit.sseq"))
    theirs = F.when(turned, seqf.reverse_complement(found)).otherwise(found)
    return snps(rows.select("locus", "sample", "allele", ours.alias("allele_seq"), theirs.alias("found_seq")))


def alignment_rows(calls: DataFrame, alleles: DataFrame, config: CallConfig = CallConfig(), protein: bool = False) -> DataFrame:
    """The new sequence of each INF, ASM or ALM call aligned with its allele: (locus, sample, allele, row, sequence).

    row is sample, match or schema. A reverse allele is turned, as in snp_rows; the new sequence is
    taken as called. With protein both are translated before, whole codons only.
    """
    a = alleles.select("locus", F.col("allele_id").alias("allele"), F.col("seq").alias("allele_seq"))
    rows = calls.filter(F.col("kind").isin("INF", "ASM", "ALM")).join(a, ["locus", "allele"])
    ours = F.when(seqf.direction(F.col("allele_seq")) == "reverse", seqf.reverse_complement(F.col("allele_seq"))).otherwise(F.col("allele_seq"))
    text = seqf.translate if protein else lambda c: c
    id_ = F.struct("locus", "sample", "allele").alias("id")
    found = local_alignments(rows.select(id_, text(F.col("final_seq")).alias("a"), text(ours).alias("b")), config.call_scoring)
    named = [F.struct(F.lit(n).alias("row"), F.col(c).alias("sequence")) for n, c in (("sample", "row_a"), ("match", "row_middle"), ("schema", "row_b"))]
    return found.select("id.*", F.explode(F.array(*named)).alias("r")).select("locus", "sample", "allele", "r.*")


def protein_rows(calls: DataFrame, alleles: DataFrame, config: CallConfig = CallConfig()) -> DataFrame:
    """alignment_rows of the proteins."""
    return alignment_rows(calls, alleles, config, protein=True)
