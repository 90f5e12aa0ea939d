"""A run: stages in order, each reused where its checkpoint holds, else computed, stored and published.

Between stages only Parquet remains, so a stage's plan starts at its inputs' files.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave import __name__ as ENGINE
from strandweave.operators import align, cluster, conserve, contrast, design, inclusivity, qc, ranking, regions, specificity
from strandweave.plans import dag, report
from strandweave.plans.checkpoint import Checkpoints, Request, tree_sha256
from strandweave.plans.config import PipelineConfig
from strandweave.plans.recorder import Recorder, missing_evidence
from strandweave.sources import fasta, genbank, ncbi, panel, sinks

VERSION = "2"
#: What does the work of external tools in each stage, as part of its fingerprint.
TOOLS = {"clustering": {"clustering": f"{ENGINE}-greedy-{VERSION}"}, "alignment": {"alignment": f"{ENGINE}-star-{VERSION}"}, "primer_design": {"oligos": f"{ENGINE}-nearest-neighbour-{VERSION}"}}


class Run:
    """Tables of a run by name: each stage's tables are Parquet folders in its state.

    The folder of a run lies on a file system that the driver and all executors mount; ``execute``
    tries that before anything runs. ``client`` reaches the archive where the input asks for one.
    """

    def __init__(self, spark: SparkSession | None, config: PipelineConfig, folder: str, client=None):
        self.spark, self.config, self.root, self.client = spark, config, Path(folder), client
        self.points, self.recorder = Checkpoints(folder, spark), Recorder(folder)
        self._datasets = None

    def put(self, stage: str, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"file://{self.points.state_path(stage).resolve()}/{name}")

    def get(self, stage: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"file://{self.points.state_path(stage).resolve()}/{name}")

    def has(self, stage: str, name: str) -> bool:
        return (self.points.state_path(stage) / name).exists()

    def status(self, stage: str) -> str:
        return self.get(stage, "status").first().status if self.has(stage, "status") else "SKIPPED"

    def told(self, stage: str, status: str) -> None:
        self.put(stage, "status", self.spark.createDataFrame([(status,)], "status string"))

    def path(self, name: str) -> str:
        return str(self.root / name)

    def report(self, name: str, stage: str, said: dict, publish=lambda: None) -> None:
        """A stage's report, written after its data: its section of the config and what it found."""
        section = asdict(self.config).get(stage)
        sinks.write_report(self.path(name), {"schema_version": 1, "stage": stage, "config": section} | said, publish)

    # stages -------------------------------------------------------------------------------------

    def panel(self):
        kinds = "name string, criticality string, roles array<string>, panel_ordinal int"
        rows = []
        if self.config.panel and self.config.panel.frozen_manifest:
            rows = [(t.name, t.criticality, list(t.roles), i) for i, t in enumerate(panel.load_manifest(self.config.panel.frozen_manifest)[1])]
        self.put("panel", "panel", self.spark.createDataFrame(rows, kinds))

    def input(self):
        c = self.config
        if c.fasta:
            df = fasta.read(self.spark, c.fasta)
        elif c.genbank:
            df = genbank.read(self.spark, c.genbank)
        else:
            folder = c.ncbi.frozen_dataset or self.path("ncbi_dataset")
            manifest = ncbi.validate_frozen(folder) if c.ncbi.frozen_dataset else ncbi.acquire(c.ncbi, folder, self.client)
            sinks.replace_text(self.root / "ncbi_dataset_manifest.json", json.dumps(manifest, indent=2, sort_keys=True) + "\n")
            df = genbank.read(self.spark, f"{folder}/{ncbi.RECORDS}")
        self.put("input", "sequences", df)

    def qc(self):
        self.put("qc", "sequences", qc.evaluate(self.get("input", "sequences"), self.config.qc).select("ordinal", "sequence_id", "status", "reason_codes"))

    def evaluation(self) -> DataFrame:
        return qc.approved(self.get("input", "sequences"), self.get("qc", "sequences"))

    def clustering(self):
        rows, c = self.evaluation(), self.config.clustering
        wanted = self.get("qc", "sequences").where(F.col("status") == qc.ACCEPTED)
        if gaps := cluster.input_gaps(rows, wanted, cluster.word_length(c.identity) if c.enabled else 0).limit(1).collect():
            raise ValueError(f"clustering: {gaps[0].problem} {gaps[0].sequence_id}")
        if c.enabled:
            self.put("clustering", "clusters", cluster.clusters(rows, c.identity))
            found = self.get("clustering", "clusters")
            if gaps := cluster.result_gaps(found, wanted).limit(1).collect():
                raise ValueError(f"clustering: {gaps[0].problem} {gaps[0].sequence_id}")
            self.put("clustering", "discovery", cluster.discovery(found))
        else:
            self.put("clustering", "discovery", rows.select("ordinal", "sequence_id"))
        chosen = self.get("clustering", "discovery")
        n = {"evaluation_count": wanted.count(), "discovery_count": chosen.count(), "status": "COMPLETE" if c.enabled else "SKIPPED", "config": asdict(c)}
        sinks.write_fasta(rows.join(chosen.select("sequence_id"), "sequence_id", "left_semi"), self.path("discovery_set.fasta"), "ordinal")
        told = self.get("clustering", "clusters").drop("ordinal") if c.enabled else chosen.limit(0).select("sequence_id")
        keys = ("cluster_id", "sequence_id") if c.enabled else ("sequence_id",)
        sinks.write_json_rows(self.path("clustering_report.json"), "members", told, *keys, **n)

    def alignment(self):
        rows = self.evaluation().join(self.get("clustering", "discovery").select("sequence_id"), "sequence_id", "left_semi")
        shape = "reference_id string, mode string, sequence_count long, reference_length long"
        if not self.config.alignment.enabled or rows.isEmpty():
            self.put("alignment", "reference", self.spark.createDataFrame([], shape))
            return
        reference, mode = align.choose_reference(rows, self.config.alignment.reference_id)
        self.put("alignment", "aligned", align.align_all(rows, reference))
        aligned = self.get("alignment", "aligned")
        if bad := align.problems(aligned, rows, reference).limit(1).collect():
            raise ValueError(f"alignment: {bad[0].problem} {bad[0].sequence_id}")
        length = rows.where(F.col("sequence_id") == reference).select(F.length("sequence")).first()[0]
        n = rows.count()
        self.put("alignment", "reference", self.spark.createDataFrame([(reference, mode, n, length)], shape))
        cells = conserve.cells(aligned.where(F.col("sequence_id") == reference))
        self.put("alignment", "coordinates", conserve.coordinate_map(cells))

        def publish():
            sinks.write_fasta(aligned.select("ordinal", "sequence_id", F.col("aligned_sequence").alias("sequence")), self.path("alignment/discovery_alignment.fasta"), "ordinal")
            sinks.write_table(self.get("alignment", "coordinates"), self.path("alignment/coordinate_map.tsv"), sinks.COORDINATES, "alignment_position")

        turned = {r.orientation: r["count"] for r in aligned.groupBy("orientation").count().collect()}
        self.report("alignment_report.json", "alignment", {"status": "COMPLETE", "reference_id": reference, "reference_mode": mode, "sequence_count": n, "orientations": turned}, publish)

    def conservation(self):
        ref = self.get("alignment", "reference").first()
        if not self.config.conservation.enabled or ref is None:
            return self.put("conservation", "consensus", self.spark.createDataFrame([], "major_consensus string, iupac_consensus string"))
        if bad := conserve.input_problems(self.get("alignment", "aligned"), self.get("alignment", "coordinates"), ref.reference_id).limit(1).collect():
            raise ValueError(f"conservation: {bad[0].problem} {bad[0].at}")
        votes = conserve.aligned_votes(self.get("alignment", "aligned"))
        self.put("conservation", "positions", conserve.vote_metrics(votes, self.get("alignment", "coordinates"), ref.sequence_count))
        pos = self.get("conservation", "positions")
        self.put("conservation", "windows", conserve.windows(pos, ref.reference_length, self.config.conservation, regions.usable(self.config.primer_design)))
        self.put("conservation", "consensus", conserve.consensus(pos))
        skipped_count = 0
        if "features" in (source := self.get("input", "sequences")).columns:
            marks, skipped = conserve.annotations(source.where(F.col("sequence_id") == ref.reference_id).select(F.inline("features")), ref.reference_length)
            self.put("conservation", "annotations", marks)
            skipped_count = int(skipped.first().skipped)
        win = self.get("conservation", "windows")

        def publish():
            named = pos.withColumnsRenamed({"major_symbol": "major_consensus", "iupac_symbol": "iupac_consensus"})
            sinks.write_table(named, self.path("conservation/position_metrics.tsv"), sinks.POSITIONS, "alignment_position")
            sinks.write_table(win, self.path("conservation/window_metrics.tsv"), sinks.WINDOWS, "reference_start")
            for kind in ("major", "iupac"):
                text = self.get("conservation", "consensus").select(F.lit(f"{kind}-consensus").alias("sequence_id"), F.col(f"{kind}_consensus").alias("sequence"))
                sinks.write_fasta(text, self.path(f"conservation/consensus_{kind}.fasta"), "sequence_id")

        top = [r.asDict() for r in conserve.top_windows(win).collect()]
        said = {"status": "COMPLETE", "reference_id": ref.reference_id, "position_count": pos.count(), "window_count": win.count(), "skipped_annotation_count": skipped_count, "top_windows": top}
        self.report("conservation/conservation_report.json", "conservation", said, publish)

    def datasets(self) -> DataFrame | None:
        """Off-target datasets as configured; frozen ones are checked, and read as GenBank."""
        if self._datasets is None and self.config.off_targets:
            paths, frozen = {}, set()
            for o in self.config.off_targets:
                if o.frozen_dataset is not None:
                    ncbi.validate_frozen(o.frozen_dataset)
                    frozen.add(o.name)
                paths[o.name] = o.fasta or f"{o.frozen_dataset}/{ncbi.RECORDS}"
            self._datasets = fasta.datasets(self.spark, paths, lambda name: genbank.read if name in frozen else fasta.read)
        return self._datasets

    def contrastive_conservation(self):
        if not self.config.contrastive_conservation.enabled or not self.has("conservation", "windows"):
            return self.told("contrastive_conservation", "SKIPPED")
        c = self.config.primer_design
        ref, win, pos = self.get("alignment", "reference").first(), self.get("conservation", "windows"), self.get("conservation", "positions")
        names = self.spark.createDataFrame([(o.name,) for o in self.config.off_targets], "dataset string")
        bound = panel.bind_challenges(self.get("panel", "panel"), names).select("dataset", "criticality", "panel_ordinal")
        if bound.isEmpty():
            raise ValueError("the approved panel has no challenge to contrast with")
        counts = self.datasets().groupBy("dataset").agg(F.count(F.lit(1)).alias("sequence_count"))
        bound = bound.join(counts, "dataset", "left").na.fill(0, ["sequence_count"])
        base = self.get("conservation", "consensus").select("major_consensus")
        asked = win.crossJoin(F.broadcast(base)).withColumn("query", F.substr("major_consensus", F.col("reference_start"), F.col("reference_end") - F.col("reference_start") + 1)).drop("major_consensus")
        found = contrast.best_matches(asked, self.datasets().join(F.broadcast(bound.select("dataset")), "dataset", "left_semi"))
        self.put("contrastive_conservation", "evidence", contrast.evidence(win, bound, found))
        every = self.get("contrastive_conservation", "evidence")
        self.put("contrastive_conservation", "summaries", contrast.summarize(every))
        told = self.get("contrastive_conservation", "summaries")
        several = contrast.candidates(told, pos, ref.reference_length, c)
        self.put("contrastive_conservation", "regions", contrast.select_candidates(several, c))
        chosen = self.get("contrastive_conservation", "regions")

        def publish():
            measures = ("mean_conservation", "minimum_conservation", "mean_coverage", "mean_gap_frequency", "mean_entropy_bits")
            rows = contrast.named_worst(told).withColumn("target_eligible", regions.eligible(c)).withColumnsRenamed({m: f"target_{m}" for m in measures})
            sinks.write_table(rows, self.path("contrastive_conservation/window_metrics.tsv"), sinks.CONTRAST_WINDOWS, "reference_start", "reference_end", quoted=True)
            by = every.withColumnsRenamed({"dataset": "dataset_name", "sequence_id": "best_sequence_id", "orientation": "best_orientation"})
            sinks.write_table(by, self.path("contrastive_conservation/dataset_metrics.tsv"), sinks.CONTRAST_DATASETS, "reference_start", "reference_end", "panel_ordinal", quoted=True)
            sinks.write_table(contrast.named_worst(chosen), self.path("contrastive_conservation/candidate_regions.tsv"), sinks.CONTRAST_REGIONS, "rank", quoted=True)
            report.contrast_page(self)

        said = {"status": "COMPLETE", "window_count": told.count(), "challenge_dataset_count": bound.count(), "candidate_region_count": chosen.count()}
        self.report("contrastive_conservation/contrastive_conservation_report.json", "contrastive_conservation", said, publish)
        self.told("contrastive_conservation", "COMPLETE")

    def regions(self) -> tuple[DataFrame, bool]:
        """Regions to design in, and whether assays must hold their peaks: contrasted ones, else conserved ones."""
        if self.status("contrastive_conservation") == "COMPLETE":
            return self.get("contrastive_conservation", "regions"), True
        ref, c = self.get("alignment", "reference").first(), self.config.primer_design
        return regions.select_regions(self.get("conservation", "windows"), self.get("conservation", "positions"), ref.reference_length, c), False

    def design_required(self) -> bool:
        """Whether a design of oligos has anything to work on."""
        return self.config.primer_design.enabled and self.has("conservation", "windows") and not self.regions()[0].isEmpty()

    def primer_design(self):
        c = self.config.primer_design
        shape = "assay_id string, region_id string"
        if not c.enabled or not self.has("conservation", "windows"):
            return self.put("primer_design", "assays", self.spark.createDataFrame([], shape))
        if not self.design_required():
            self.report("primer_design/primer_design_report.json", "primer_design", {"status": "COMPLETE", "candidate_region_count": 0, "assay_count": 0})
            return self.put("primer_design", "assays", self.spark.createDataFrame([], shape))
        pos = self.get("conservation", "positions")
        chosen, anchored = self.regions()
        self.put("primer_design", "regions", chosen)
        chosen = self.get("primer_design", "regions")
        template = self.get("conservation", "consensus").select(F.col("major_consensus").alias("sequence"))
        self.put("primer_design", "exclusions", regions.exclusions(chosen, pos, c))
        runs = self.get("primer_design", "exclusions")
        self.put("primer_design", "assays", design.assays(chosen, template, runs, c, anchored))
        found = self.get("primer_design", "assays")
        if bad := design.problems(found, chosen, c, anchored).limit(1).collect():
            raise ValueError(f"primer_design: {bad[0].problem} {bad[0].assay_id}")

        def publish():
            sinks.write_table(chosen, self.path("primer_design/candidate_regions.tsv"), sinks.REGIONS, "rank")
            flat = [F.col(f"{o}.{k}").alias(f"{o}_{k}") for o in ("forward", "probe", "reverse") for k in sinks.OLIGO_FIELDS]
            sinks.write_table(found.select("assay_id", "region_id", "primer3_index", *flat, "product_size", "pair_penalty"), self.path("primer_design/assays.tsv"), sinks.ASSAYS, "assay_id")
            tags = regions.excluded_tags(runs).select("region_id", F.col("tag").alias("excluded"))
            sinks.write_table(design.tool_input(chosen, template, tags, c), self.path("primer_design/primer3_input.txt"), ("value",), "rank", bare=True)
            report.assay_page(self)

        source = "CONTRASTIVE_CONSERVATION" if anchored else "CONSERVATION_ONLY"
        self.report("primer_design/primer_design_report.json", "primer_design", {"status": "COMPLETE", "candidate_source": source, "candidate_region_count": chosen.count(), "assay_count": found.count()}, publish)

    def assays(self) -> DataFrame | None:
        found = self.get("primer_design", "assays")
        return found if "forward" in found.columns and not found.isEmpty() else None

    def inclusivity(self):
        found, c = self.assays(), self.config.inclusivity
        if not c.enabled or found is None:
            return self.told("inclusivity", "SKIPPED")
        rows = self.evaluation()
        self.put("inclusivity", "bindings", inclusivity.bindings(rows, found, c))
        bound, n = self.get("inclusivity", "bindings"), rows.count()
        self.put("inclusivity", "variations", inclusivity.variations(bound, found, n, c, with_ids=True))
        self.put("inclusivity", "proposals", inclusivity.proposals(bound, found, c))
        proposed = inclusivity.proposed_compatibility(bound, self.get("inclusivity", "proposals"), c)
        self.put("inclusivity", "results", inclusivity.assay_results(bound, proposed))
        results, offered = self.get("inclusivity", "results"), self.get("inclusivity", "proposals")
        if gaps := ranking.evidence_gaps(found, results, ["assay_id", "sequence_id"], found.select("assay_id").crossJoin(rows.select("sequence_id"))).limit(1).collect():
            raise ValueError(f"inclusivity: {gaps[0].problem} {gaps[0].assay_id} {gaps[0].sequence_id}")
        role = specificity.role_ordinal()

        def publish():
            matches = inclusivity.oligo_matches(bound)
            sinks.write_table(matches, self.path("inclusivity/oligo_matches.tsv"), sinks.OLIGO_MATCHES, "assay_id", "ordinal", role, "orientation", "hit_rank")
            sinks.write_table(results, self.path("inclusivity/assay_inclusivity.tsv"), sinks.ASSAY_INCLUSIVITY, "assay_id", "ordinal")
            sinks.write_table(self.get("inclusivity", "variations"), self.path("inclusivity/oligo_variations.tsv"), sinks.VARIATIONS, "assay_id", role, "oligo_position")
            sinks.write_table(offered, self.path("inclusivity/degeneracy_proposals.tsv"), sinks.PROPOSALS, "assay_id", role)

        counts = inclusivity.counts(results).agg(F.sum("original_compatible_count").alias("original_compatible_count"), F.sum("proposed_compatible_count").alias("proposed_compatible_count")).first().asDict()
        said = {"status": "COMPLETE", "evaluation_sequence_count": n, "assay_count": found.count()} | counts
        self.report("inclusivity/inclusivity_report.json", "inclusivity", said, publish)
        self.told("inclusivity", "COMPLETE")

    def specificity(self):
        found = self.assays()
        if not self.config.specificity.enabled or found is None:
            return self.told("specificity", "SKIPPED")
        c, off = self.config.specificity, self.datasets()
        order = found.select("assay_id", F.concat("region_id", F.format_string("-%05d", "primer3_index")).alias("o"))
        oligos = design.long_view(found).join(order, "assay_id").withColumnRenamed("o", "assay_ordinal").select("assay_id", "assay_ordinal", "role", "sequence")
        self.put("specificity", "hits", specificity.off_target_hits(off, oligos, c))
        hits = self.get("specificity", "hits")
        names = self.spark.createDataFrame([(o.name,) for o in self.config.off_targets], "dataset string")
        self.put("specificity", "retained", specificity.retained(hits, c))
        self.put("specificity", "retention", specificity.retention(hits, names, found, c))
        kept = self.get("specificity", "retained")
        self.put("specificity", "amplicons", specificity.with_ranks(specificity.amplicons(hits, c), kept))
        amplicons = self.get("specificity", "amplicons")

        def publish():
            sinks.write_table(kept.withColumnRenamed("dataset", "dataset_name"), self.path("specificity/off_target_hits.tsv"), sinks.OFF_TARGET_HITS, "dataset_ordinal", *specificity.enumeration_order())
            rows = amplicons.join(F.broadcast(self._dataset_order()), "dataset").withColumnRenamed("dataset", "dataset_name")
            sinks.write_table(rows, self.path("specificity/plausible_amplicons.tsv"), sinks.AMPLICONS, "dataset_ordinal", "assay_id", "ordinal", "orientation", "source_start", "source_end")

        total = specificity.summary(hits, amplicons).first().asDict()
        said = {"status": "COMPLETE", "dataset_count": len(self.config.off_targets), "sequence_count": off.count(), "assay_count": found.count(), "retained_hit_count": kept.count()} | total
        said["retention"] = [r.asDict() for r in self.get("specificity", "retention").where("truncated").orderBy("dataset", "assay_id", "role").toLocalIterator()]
        self.report("specificity/specificity_report.json", "specificity", said, publish)
        self.told("specificity", "COMPLETE")

    def _dataset_order(self) -> DataFrame:
        return self.spark.createDataFrame([(o.name, i) for i, o in enumerate(self.config.off_targets)], "dataset string, dataset_ordinal int")

    def evidence(self) -> DataFrame:
        """What ranking reads, one row per assay."""
        found = self.assays().select("assay_id", "region_id", "primer3_index", "pair_penalty")
        means = ("mean_conservation", "minimum_conservation", "mean_coverage", "mean_gap_frequency", "mean_entropy_bits")
        rows = found.join(F.broadcast(self.get("primer_design", "regions").select("region_id", *means)), "region_id")
        none, pair = F.array().cast("array<string>"), "array<struct<original:bigint,proposed:bigint>>"
        if self.status("inclusivity") == "COMPLETE":
            told = inclusivity.counts(self.get("inclusivity", "results")).select("assay_id", "evaluation_sequence_count", "original_compatible_count")
            p = self.get("inclusivity", "proposals").withColumn("o", specificity.role_ordinal())
            of = lambda s: F.transform(F.sort_array(F.collect_list(F.when(F.col("status") == s, F.struct("o", "role")))), lambda x: x["role"])
            sizes = F.collect_list(F.when(F.col("status") == "ACCEPTED", F.struct(F.col("original_degeneracy").alias("original"), F.col("proposed_degeneracy").alias("proposed"))))
            rows = rows.join(told, "assay_id", "left").join(p.groupBy("assay_id").agg(of("ACCEPTED").alias("accepted_roles"), of("REJECTED").alias("rejected_roles"), sizes.alias("accepted_degeneracies")), "assay_id", "left")
            rows = rows.withColumn("evaluation_sequence_count", F.coalesce("evaluation_sequence_count", F.lit(0)))
        else:
            rows = rows.withColumns({"evaluation_sequence_count": F.lit(None).cast("long"), "original_compatible_count": F.lit(None).cast("long"), "accepted_roles": none, "rejected_roles": none, "accepted_degeneracies": F.array().cast(pair)})
        if self.status("specificity") == "COMPLETE":
            hits = self.get("specificity", "hits").groupBy("assay_id").agg(F.count(F.lit(1)).alias("compatible_hit_count"))
            amps = self.get("specificity", "amplicons").groupBy("assay_id").agg(F.count(F.lit(1)).alias("plausible_count"), F.count_if("detectable_off_target").alias("detectable_count"))
            rows = rows.join(hits, "assay_id", "left").join(amps, "assay_id", "left").fillna(0, ["compatible_hit_count", "plausible_count", "detectable_count"])
        else:
            rows = rows.withColumns({n: F.lit(None).cast("long") for n in ("compatible_hit_count", "plausible_count", "detectable_count")})
        return rows.withColumns({"inclusivity_status": F.lit(self.status("inclusivity")), "specificity_status": F.lit(self.status("specificity"))})

    def missing(self, final: str | None = None) -> list[str]:
        found = self.assays()
        return missing_evidence(self.evaluation().count(), 0 if found is None else found.count(), self.status("inclusivity"), self.status("specificity"), final)

    def ranking(self):
        if not self.config.ranking.enabled or self.assays() is None:
            return self.told("ranking", "SKIPPED")
        rows = self.evidence()
        if gaps := ranking.evidence_gaps(self.assays(), rows, ["assay_id"], self.assays().select("assay_id")).limit(1).collect():
            raise ValueError(f"ranking: {gaps[0].problem} {gaps[0].assay_id}")
        if bad := ranking.invalid_evidence(rows).limit(1).collect():
            raise ValueError(f"ranking: {bad[0].problem} {bad[0].assay_id}")
        self.put("ranking", "ranked", ranking.rank(rows, self.config.ranking, self.missing()))
        ranked = self.get("ranking", "ranked")
        out = ranked.withColumnsRenamed({f"{n}_score": n for n in ranking.COMPONENTS} | {"compatible_hit_count": "compatible_off_target_hit_count", "plausible_count": "plausible_off_target_count", "detectable_count": "detectable_off_target_count"})
        out = out.withColumns({"inclusivity_fraction": F.col("inclusivity"), "reason_codes": F.array_join("reasons.code", ";")})
        best = ranking.recommended(ranked).first().assay_id
        told = {f"{r.classification} {r.score_status}": r.n for r in ranking.report_counts(ranked).collect()}
        publish = lambda: sinks.write_table(out, self.path("ranking/assay_ranking.tsv"), sinks.RANKING, "rank")
        self.report("ranking/ranking_report.json", "ranking", {"status": "COMPLETE", "assay_count": ranked.count(), "counts": told, "top_recommended_assay_id": best}, publish)
        self.told("ranking", "COMPLETE")

    # control ------------------------------------------------------------------------------------

    def request(self, stage: str) -> Request:
        c = asdict(self.config)
        own = {"panel": "panel", "qc": "qc"}.get(stage, stage)
        parameters = {own: c.get(own)} if own in c else {}
        inputs = {}
        if stage == "input":
            parameters = {k: c[k] for k in ("fasta", "genbank", "ncbi")}
            frozen = self.config.ncbi and self.config.ncbi.frozen_dataset
            inputs = {p: _identity(p) for p in (self.config.fasta, self.config.genbank, frozen) if p}
        if stage in ("contrastive_conservation", "specificity"):
            parameters["off_targets"] = c["off_targets"]
            inputs = {o.name: _identity(o.fasta or o.frozen_dataset) for o in self.config.off_targets}
        if stage == "contrastive_conservation":
            parameters["regions"] = {k: v for k, v in c["primer_design"].items() if k not in ("primer", "probe", "product_size_min", "product_size_max", "assays_per_region", "enabled")}
        if stage == "panel" and self.config.panel and self.config.panel.frozen_manifest:
            inputs = {"manifest": _identity(self.config.panel.frozen_manifest)}
        return Request(stage, {d: self.points.result_fingerprint(d) for d in dag.NEEDS[stage]}, inputs, parameters, {"engine": ENGINE, "version": VERSION}, TOOLS.get(stage, {}))

    def valid(self, stage: str) -> bool:
        return self.points.problem(self.request(stage)) is None

    def _shared(self) -> None:
        """Fails where an executor doesn't see the run's folder, which would lose what it writes there."""
        if self.spark.conf.get("spark.master", "local").startswith("local"):
            return
        token = self.root / f".seen-{uuid.uuid4().hex}"
        token.parent.mkdir(parents=True, exist_ok=True)
        token.touch()
        at = str(token.resolve())

        def look(batches):
            for _ in batches:
                yield pa.record_batch([pa.array([os.path.exists(at)])], names=["seen"])

        n = self.spark.sparkContext.defaultParallelism
        try:
            if self.spark.range(0, n, 1, n).mapInArrow(look, "seen boolean").where("not seen").limit(1).collect():
                raise ValueError(f"{self.root} must lie on a file system that all executors mount")
        finally:
            token.unlink()

    def execute(self, policy: dag.Policy = dag.Policy(), target: str | None = None) -> str:
        """Run what must run; COMPLETED, PARTIAL or ACTION_REQUIRED. A failure is recorded and raised."""
        target = target or self.config.target_name
        self.recorder.begin(target)
        self.recorder.log("environment_inspected")
        try:
            self._shared()
            ready = panel.preflight(self.config.panel, str(self.root), target)
            if ready["status"] == "ACTION_REQUIRED":
                return self.recorder.action_required("PANEL_APPROVAL", ready["proposal"])
            actions = dag.plan(policy, self.valid)
        except Exception as error:
            self.recorder.fail("preflight", error)
            raise
        self.recorder.log("plan_created")
        for stage in dag.STAGES:
            if actions[stage] == "REUSE":
                self.recorder.stage(stage, "REUSE", "stage_reused", checkpoint_path=str(self.points.manifest_path(stage)))
                continue
            request = self.request(stage)
            self.points.begin(request)
            self.recorder.stage(stage, actions[stage], "stage_started")
            try:
                getattr(self, stage)()
            except Exception as error:
                self.points.fail(request, error)
                self.recorder.fail(stage, error)
                raise
            self.points.complete(request)
            self.recorder.stage(stage, actions[stage], "stage_completed", checkpoint_path=str(self.points.manifest_path(stage)))
        missing = self.missing(self.status("ranking"))
        status = self.recorder.finish(missing)
        report.publish_summary(self, status, missing)
        return status


def _identity(path: str) -> str | None:
    """Hash of an input; null where it isn't there, which only a dry run meets."""
    return tree_sha256(Path(path)) if Path(path).exists() else None
