"""The jobs' intermediate tables over the derived genomics tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate, calling, coverage, genome, reads, rollup
from ..sources.scratch import shared
from . import domain


#: Tables that several jobs read: written once for an application and data folder, so that jobs start
#: from files instead of repeating the joins behind them.
STORED = {"genome_k", "glen", "sites", "indels", "regions", "transcripts", "genes", "known", "reads", "classified", "cube", "vbed", "parsed_variants", "hits", "variants", "tx", "pairs", "effects", "plain_ties", "sums"}
_frames: dict = {}


def forget() -> None:
    """Later jobs make their tables anew, as they must after a folder's tables were written again."""
    _frames.clear()


def frames(spark: SparkSession, sf_dir: str) -> Frames:
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _frames:
        _frames[key] = Frames(spark, sf_dir)
    return _frames[key]


class Frames:
    """Lazily built DataFrames of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        made = self.__dict__["_made"]
        if name not in made:
            make = getattr(type(self), f"_{name}", None)
            df = make(self) if make else domain.table(self.spark, self.sf_dir, name, lambda t: getattr(self, t) if t in STORED else None)
            if name in STORED:
                path = shared(self.spark, name)
                df.write.parquet(path)
                df = self.spark.read.schema(df.schema).parquet(path)
            made[name] = df
        return made[name]

    def _sizes(self):
        return genome.sizes(self.genome)

    def _cube(self):
        return coverage.cube(self.sites, self.regions)

    def _target(self):
        return coverage.target_size(self.regions)

    def _classified(self):
        return reads.classified(self.reads)

    def _routed(self):
        return reads.routed(self.classified)

    def _snvs(self):
        return calling.snvs(self.sites)

    def _called_indels(self):
        return calling.indels(self.indels)

    def _vbed(self):
        snv = calling.snv_vbed(self.snvs).withColumn("idx", (F.col("stop") * 2).cast("long"))
        indel = calling.indel_vbed(self.called_indels, self.genome)
        return snv.unionByName(indel.withColumn("idx", (F.col("stop") * 2 + 1).cast("long")))

    def _parsed_variants(self):
        return annotate.parse_vbed(self.vbed)

    def _hits(self):
        return annotate.known_hits(self.parsed_variants, self.known)

    def _variants(self):
        return annotate.with_status(self.parsed_variants, self.hits)

    def _canonical_tx(self):
        return self.transcripts.join(self.genes.where("tx_id % 3 <> 0").select("tx_id"), "tx_id", "left_semi")

    def _tx(self):
        return annotate.eligible(self.canonical_tx)

    def _pairs(self):
        return annotate.candidates(self.variants, self.tx)

    def _cds(self):
        hit = self.pairs.select("tx_id").distinct()
        return annotate.coding_sequences(self.tx.join(hit, "tx_id", "left_semi"), self.genome)

    def _effects(self):
        return annotate.codon_effects(self.pairs, self.cds, self.genome)

    def _plain_ties(self):
        return annotate.ties(self.pairs)

    def _ties(self):
        return self.plain_ties.unionByName(annotate.effect_ties(self.effects))

    def _sums(self):
        return rollup.transcript_sums(self.ties)

    def _groups(self):
        return rollup.inheritance(self.sums)

    def _gene_groups(self):
        return rollup.with_genes(self.groups, self.genes)

    def _predictions(self):
        e = self.effects.where("ref_aa <> alt_aa").select("var_id", "tx_id", "allele", "rel_start").distinct()
        snp = F.concat_ws(".", "var_id", "tx_id")
        kind = F.when(F.col("rel_start") % 3 == 0, "benign").when(F.col("rel_start") % 3 == 1, "possibly damaging").otherwise("probably damaging")
        return e.select(F.xxhash64("var_id", "tx_id", "allele").alias("_x"), "var_id", "tx_id", snp.alias("snp_id"), F.col("allele").alias("nt1"), F.col("allele").alias("nt2"), kind.alias("prediction"), (F.col("rel_start") * 8 + F.ascii("allele") % 8).alias("line")).drop("_x")
