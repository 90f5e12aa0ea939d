import json
import urllib.error

import pytest

from strandweave.operators.match import Oligo
from strandweave.plans import cli, config, dag, recorder
from strandweave.plans.checkpoint import Checkpoints, Request
from strandweave.plans.config import ConfigError, NcbiInputConfig, PipelineConfig, SpecificityConfig
from strandweave.plans.storage import number_rows, running_sum
from strandweave.sources import fasta, genbank, ncbi, panel, sinks
from strandweave.streaming import arrivals


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">s1 first one\r\nacg\r\nTT\r\n>s2\n\n>s3  x\nAC GT\n")
    got = [(r.sequence_id, r.sequence) for r in fasta.read(spark, str(tmp_path / "a.fasta")).orderBy("ordinal").collect()]
    assert got == [("s1", "ACGTT"), ("s2", ""), ("s3", "ACGT")]
    (tmp_path / "e.fasta").write_text("")
    sets = fasta.datasets(spark, {"one": str(tmp_path / "a.fasta"), "none": str(tmp_path / "e.fasta")})
    assert sets.groupBy("dataset").count().collect() == [("one", 3)]
    (tmp_path / "d.fasta").write_text(">x\nA\n>x\nC\n")
    with pytest.raises(ValueError, match="repeated"):
        fasta.datasets(spark, {"d": str(tmp_path / "d.fasta")})


def test_fasta_split_into_many_parts(spark, tmp_path):
    records = [(f"id{i}", "ACGT" * (i % 50)) for i in range(3000)]
    (tmp_path / "big.fasta").write_text("".join(f">{n}\n{s}\n" for n, s in records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = fasta.read(spark, str(tmp_path / "big.fasta"))
        assert [(r.sequence_id, r.sequence) for r in df.orderBy("ordinal").collect()] == records
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        assert [(r.ordinal, r.sequence_id) for r in df.orderBy("ordinal").collect()] == [(i, n) for i, (n, _) in enumerate(records)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_of_several_files_are_numbered_by_file(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for i, n in enumerate((400, 3, 90, 1)):  # splits are packed by size, which must not tell
        (tmp_path / f"d/{i}.fasta").write_text(("no record\n" if i == 2 else "") + "".join(f">f{i}r{j}\nACGT\n" for j in range(n)))
    got = [(r.ordinal, r.sequence_id) for r in fasta.read(spark, str(tmp_path / "d")).orderBy("ordinal").collect()]
    assert [n for _, n in got] == [f"f{i}r{j}" for i, n in enumerate((400, 3, 90, 1)) for j in range(n)]
    assert len({o for o, _ in got}) == len(got)


GENBANK = """LOCUS       AB1 20 bp DNA
DEFINITION  A test
            record.
ACCESSION   AB1
VERSION     AB1.2
FEATURES             Location/Qualifiers
     source          1..20
                     /organism="x y"
     CDS             complement(join(2..5,
                     <8..>10))
                     /gene="g1"
                     /note="long
                     note"
     misc            J00194.1:1..3
ORIGIN
        1 acgtacgtac gtacgtacgt
//
LOCUS       AB2 4 bp
ORIGIN
        1 ttaa
//
"""


def test_genbank(spark, tmp_path):
    (tmp_path / "a.gb").write_text(GENBANK)
    a, b = genbank.read(spark, str(tmp_path / "a.gb")).orderBy("ordinal").collect()
    assert (a.sequence_id, a.sequence, a.description, b.sequence_id, b.sequence) == ("AB1.2", "ACGT" * 5, "A test record", "AB2", "TTAA")
    cds = a.features[1]
    assert [(p.start, p.end, p.strand) for p in cds.parts] == [(7, 10, -1), (1, 5, -1)] and cds.qualifiers == {"gene": ["g1"], "note": ["long note"]}
    assert a.features[2].parts[0].ref == "J00194.1"


def genbank_text(name, seq="acgt"):
    return f"LOCUS       {name} {len(seq)} bp DNA\nACCESSION   {name}\nVERSION     {name}.1\nFEATURES             Location/Qualifiers\n     gene            1..3\n                     /gene=\"g\"\nORIGIN\n        1 {seq}\n//\n"


class Archive:
    """Answers in pages of three, and with records in the reverse of the order asked for."""

    def __init__(self, n, failures=0):
        self.n, self.failures, self.fetched = n, failures, []

    def search(self, query, start, size):
        if self.failures:
            self.failures -= 1
            raise urllib.error.HTTPError("u", 503, "busy", {}, None)
        return self.n, [str(i) for i in range(start, min(self.n, start + min(size, 3)))], "meant"

    def fetch(self, ids, kind):
        self.fetched.append(list(ids))
        return [(i, genbank_text(f"R{i}")) for i in reversed(ids)]


def test_archive_resumes_and_validates(spark, tmp_path):
    waits = []
    c = NcbiInputConfig(query="q", batch_size=2, retries=3)
    client = Archive(5, failures=3)
    m = ncbi.acquire(c, str(tmp_path), client, waits.append)
    assert waits == [1, 2, 4] and m["status"] == "COMPLETE" and len(client.fetched) == 3
    assert ncbi.validate_frozen(str(tmp_path))["source"]["resolved_uids"] == ["0", "1", "2", "3", "4"]
    rows = genbank.read(spark, str(tmp_path / ncbi.RECORDS)).orderBy("ordinal").collect()
    assert [r.sequence_id for r in rows] == [f"R{i}.1" for i in range(5)] and rows[0].features[0].qualifiers == {"gene": ["g"]}
    again = Archive(5)
    assert ncbi.acquire(c, str(tmp_path), again, waits.append)["status"] == "COMPLETE" and again.fetched == []
    (tmp_path / "batches/batch-00001.gb").write_text("changed")
    with pytest.raises(ValueError, match="batch-00001.gb"):
        ncbi.validate_frozen(str(tmp_path))
    ncbi.acquire(c, str(tmp_path), again, waits.append)
    assert again.fetched == [["2", "3"]]
    with pytest.raises(ValueError, match="another dataset"):
        ncbi.acquire(NcbiInputConfig(query="other", batch_size=2), str(tmp_path), again)
    with pytest.raises(urllib.error.HTTPError):
        ncbi.with_retries(lambda: (_ for _ in ()).throw(urllib.error.HTTPError("u", 404, "no", {}, None)), 5, waits.append)
    assert [i for i, _ in ncbi.by_accession(["B", "A.1"], [genbank_text("A"), genbank_text("B")])] == ["A.1", "B"]
    with pytest.raises(ValueError, match="not those asked for"):
        ncbi.by_accession(["B"], [genbank_text("C")])


@pytest.mark.parametrize("change,said", [
    (lambda m: m.pop("tool"), "lacks: tool"), (lambda m: m.update(extra=1), "unknown fields: extra"), (lambda m: m.update(status="PARTIAL"), "COMPLETE"), (lambda m: m.update(batch_size=True), "batch_size"),
    (lambda m: m.update(created_at="2024-01-01"), "UTC"), (lambda m: m["source"].update(selected_count=9), "selected_count"), (lambda m: m["source"].update(mode="x"), "source.mode"),
    (lambda m: m["resolved_entries"].reverse(), "resolved_entries"), (lambda m: m["completed_batches"].pop(), "does not cover"), (lambda m: m["consolidated"].update(sha256="0" * 64), "was changed"),
    (lambda m: m["completed_batches"][0].update(record_ids=["x", "y"]), "record_ids"), (lambda m: m["resolved_entries"][0].update(accession="Z"), "accession"),
])
def test_frozen_datasets_are_checked_field_by_field(tmp_path, change, said):
    ncbi.acquire(NcbiInputConfig(query="q", batch_size=2), str(tmp_path), Archive(4))
    m = json.loads((tmp_path / ncbi.MANIFEST).read_text())
    change(m)
    (tmp_path / ncbi.MANIFEST).write_text(json.dumps(m))
    with pytest.raises(ValueError, match=said):
        ncbi.validate_frozen(str(tmp_path))


def test_archive_client_speaks_to_the_service(monkeypatch):
    import io

    asked = []

    def opener(url, data, timeout):
        asked.append((url, data.decode()))
        return io.BytesIO(json.dumps({"esearchresult": {"count": "2", "idlist": ["7", "8"], "querytranslation": "t"}}).encode() if "esearch" in url else (genbank_text("B") + genbank_text("A")).encode())

    client = ncbi.EntrezClient("me@example.org", "key", opener)
    assert client.search("q", 0, 10) == (2, ["7", "8"], "t") and [x for x, _ in client.fetch(["7", "8"], "uid")] == ["7", "8"]
    assert dict(client.fetch(["A", "B"], "accession"))["A"].startswith("LOCUS       A ") and "email=me%40example.org" in asked[0][1]
    assert "key" not in repr(client) and "me@" not in repr(client)
    monkeypatch.delenv("NCBI_EMAIL", raising=False)
    with pytest.raises(ValueError, match="NCBI_EMAIL"):
        ncbi.EntrezClient()


def test_panel(spark, tmp_path):
    entries = [{"name": "Virus A", "criticality": "CRITICAL", "roles": ["CHALLENGE"]}]
    panel.propose(str(tmp_path / "p.yaml"), "t", entries)
    panel.approve(str(tmp_path / "p.yaml"), str(tmp_path / "m.json"))
    assert panel.load_manifest(str(tmp_path / "m.json")) == ("t", [panel.NonTarget("Virus A", "CRITICAL", ("CHALLENGE",))])
    m = json.loads((tmp_path / "m.json").read_text())
    for change, said in ((lambda d: d["target"].update(taxid=0), "taxid"), (lambda d: d["target"].update(subtype="x"), "subtype"), (lambda d: d["target"].update(groups=[]), "groups"), (lambda d: d["non_targets"][0].update(name=" T "), "name the target"), (lambda d: d["non_targets"].append(dict(d["non_targets"][0])), "unique names"), (lambda d: d["non_targets"][0].update(dataset_roles=["DISCOVERY"]), "DESIGN"), (lambda d: d.pop("diagnostic_context"), "exactly the fields")):
        bad = json.loads(json.dumps(m))
        change(bad["definition"])
        (tmp_path / "bad.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError, match=said):
            panel.load_manifest(str(tmp_path / "bad.json"))
    p = spark.createDataFrame([("Virus A", "CRITICAL", ["CHALLENGE"], 0)], "name string, criticality string, roles array<string>, panel_ordinal int")
    assert panel.bind_challenges(p, spark.createDataFrame([(" virus a",)], "dataset string")).first().dataset == " virus a"
    with pytest.raises(Exception, match="no dataset for panel entry Virus A"):
        panel.bind_challenges(p, spark.createDataFrame([("b",)], "dataset string")).collect()


def test_tables_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(2, None, [1, 2], [(1, 5), (7, 9)], True), (1, "a\tb", [], None, False)], "k int, s string, l array<int>, p array<struct<start:int,end:int>>, f boolean")
    sinks.write_table(df, str(tmp_path / "t.tsv"), ("k", "s", "l", "p", "f"), "k")
    assert (tmp_path / "t.tsv").read_text() == "k\ts\tl\tp\tf\n1\ta b\t\t\tfalse\n2\t\t1,2\t1-5,7-9\ttrue\n"
    sinks.write_table(df, str(tmp_path / "q.tsv"), ("k", "s", "p"), "k", quoted=True)
    assert (tmp_path / "q.tsv").read_text() == 'k\ts\tp\n1\t"a\tb"\t\n2\t\t[[1, 5], [7, 9]]\n'
    back = sinks.read_table(spark, str(tmp_path / "t.tsv"), "k int, s string, l string, p string, f boolean").orderBy("k").collect()
    assert [(r.k, r.l, r.f) for r in back] == [(1, None, False), (2, "1,2", True)]
    sinks.write_json_rows(str(tmp_path / "j.json"), "rows", df.select("k", "s"), "k", n=2)
    assert json.loads((tmp_path / "j.json").read_text()) == {"n": 2, "rows": [{"k": 1, "s": "a\tb"}, {"k": 2, "s": None}]}
    sinks.write_fasta(spark.createDataFrame([("b", "ACGTAC", 1), ("a", "", 0)], "sequence_id string, sequence string, o int"), str(tmp_path / "f.fasta"), "o", line=4)
    assert (tmp_path / "f.fasta").read_text() == ">a\n\n>b\nACGT\nAC\n"
    sinks.write_report(str(tmp_path / "r.json"), {"b": 1, "a": 2}, lambda: None)
    with pytest.raises(RuntimeError):
        sinks.write_report(str(tmp_path / "r.json"), {}, lambda: (_ for _ in ()).throw(RuntimeError))
    assert not (tmp_path / "r.json").exists()
    assert sinks.line_chart([(0, 0.5), (1, None), (2, 1.0), (3, 2.0)]).count("<polyline") == 2


def test_order_over_tables(spark):
    df = spark.range(1000).selectExpr("id", "cast(id * 37 % 1000 as int) as v").repartition(7)
    got = {r.v: r.n for r in number_rows(df, "n", "v").collect()}
    assert got == {v: v + 1 for v in range(1000)}
    from pyspark.sql import functions as F

    sums = {r.v: r.s for r in running_sum(df, "v", F.col("v"), "s", block=64).collect()}
    assert sums == {v: v * (v + 1) // 2 for v in range(1000)}


def test_stages():
    assert dag.descendants("primer_design") == ("inclusivity", "specificity", "ranking")
    assert dag.dependencies("clustering") == ("input", "qc")
    assert dag.plan(dag.Policy(), lambda s: True)["qc"] == "RUN"
    below = {"conservation", *dag.descendants("conservation")}
    forced = {s: "FORCED" if s in below else "REUSE" for s in dag.STAGES}
    assert dag.plan(dag.Policy(resume=True, force_step="conservation"), lambda s: True) == forced
    # what rests on a stage that must run is forced, whether or not its own checkpoint holds
    assert dag.plan(dag.Policy(resume=True), lambda s: s != "conservation") == forced | {"conservation": "RUN"}
    # from a step: stages that nothing forced needs are left alone, valid or not
    assert dag.plan(dag.Policy(from_step="specificity"), lambda s: s != "panel" or True) == {s: "FORCED" if s in ("specificity", "ranking") else "REUSE" for s in dag.STAGES}
    with pytest.raises(ValueError, match="no valid checkpoint of alignment"):
        dag.plan(dag.Policy(from_step="conservation"), lambda s: s != "alignment")
    with pytest.raises(ValueError):
        dag.Policy(force_step="qc")


FULL = """
target: {name: West Nile virus}
input:
  ncbi: {query: '"x"[Organism]', batch_size: 20, retries: 5, max_records: 50}
qc: {min_length: 5, max_ambiguous_fraction: 0.05, expected_length: 11000, length_tolerance_fraction: 0.1, note: unread}
clustering: {enabled: true, identity: 0.95, threads: 4, memory_mb: 2048}
alignment: {enabled: true, threads: 2, reference_id: seq-3}
conservation: {enabled: true, window_size: 100, step_size: 20}
primer_design:
  enabled: true
  max_candidate_regions: 6
  assays_per_region: 3
  product_size_min: 80
  product_size_max: 150
  primer: {min_tm: 57, min_gc_percent: 35}
  probe: {max_gc_percent: 70.5}
inclusivity: {enabled: true, max_hits_per_oligo: 5}
off_targets: [{name: Usutu virus, frozen_dataset: a/b}, {name: Other, fasta: x.fasta}]
specificity: {enabled: true}
ranking: {enabled: true, weights: {inclusivity: 0.4, specificity: 0.2}}
panel: {frozen_manifest: approved.json}
contrastive_conservation: {enabled: true}
anything_else: 1
"""


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text(FULL)
    c = config.load(str(tmp_path / "c.yaml"))
    assert c.target_name == "West Nile virus" and c.ncbi.max_records == 50 and c.primer_design.assays_per_region == 3
    # sections that name some fields keep their own defaults for the others
    assert (c.primer_design.primer.min_tm, c.primer_design.primer.min_gc_percent, c.primer_design.primer.opt_tm) == (57.0, 35.0, 60.0)
    assert (c.primer_design.probe.max_gc_percent, c.primer_design.probe.opt_tm) == (70.5, 70.0)
    base = {"target": {"name": "t"}, "input": {"fasta": "x.fasta"}}
    (tmp_path / "c.json").write_text(json.dumps(base | {"qc": {"min_length": 5}}))
    assert config.load(str(tmp_path / "c.json")).qc.min_length == 5
    proposal = panel.definition_of("t", [{"name": "n", "criticality": "CRITICAL", "roles": ["CHALLENGE"]}])
    assert config.parse(base | {"panel": {"proposal": proposal}}).panel.proposal["target"]["name"] == "t"
    for bad, said in (
        ({"qc": {"min_length": True}}, "invalid"), ({"clustering": {"qq": 1}}, "unknown"), ({"ranking": {"weights": {"inclusivity": 0.5}}}, "sum to 1"), ({"conservation": {"enabled": True}}, "requires alignment"),
        ({"input": {"fasta": "x", "genbank": "y"}}, "exactly one"), ({"target": {}}, "target.name"), ({"input": {"ncbi": {"accessions": ["a", "a"]}}}, "unique"), ({"input": {"ncbi": {"accessions": ["a"], "max_records": 3}}}, "needs a query"),
        ({"input": {"ncbi": {"frozen_dataset": "d", "retries": 4}}}, "excludes"), ({"primer_design": {"candidate_region_length": 100}}, "at least product_size_max"), ({"inclusivity": {"max_hits_per_oligo": 0}}, "max_hits_per_oligo"),
        ({"panel": {"proposal": proposal | {"target": proposal["target"] | {"name": "u"}}}}, "not target.name"), ({"panel": {"proposal": {}}}, "exactly the fields"), ({"clustering": {"threads": 0}}, "threads"),
    ):
        with pytest.raises(ConfigError, match=said):
            config.parse(base | bad)


def test_recorder(tmp_path):
    r = recorder.Recorder(str(tmp_path), lambda: "now")
    r.begin("t")
    r = recorder.Recorder(str(tmp_path), lambda: "now")
    r.begin("t")
    assert [a["status"] for a in r.manifest["attempts"]] == ["FAILED", "RUNNING"] and r.manifest["attempts"][0]["error_type"] == "INTERRUPTED"
    r.fail("qc", ValueError("bad " + "ACGT" * 20))
    assert "[SEQUENCE_REDACTED]" in (tmp_path / "run.log.jsonl").read_text()
    assert recorder.clean({"api_key": "x", "a": ["y"]}) == {"api_key": "[REDACTED]", "a": ["y"]}
    assert recorder.clean({"my-token": "x", "tokens": 1, "note": "AC-GT" * 8}) == {"my-token": "[REDACTED]", "tokens": 1, "note": "[SEQUENCE_REDACTED]"}
    assert recorder.missing_evidence(0, 1, "COMPLETE", "SKIPPED", "COMPLETE") == ["EMPTY_EVALUATION_SET", "SPECIFICITY_NOT_COMPLETE"]
    with pytest.raises(ValueError):
        r.log("run_started", sequence="x")


def test_checkpoint_problems(tmp_path):
    points, req = Checkpoints(str(tmp_path)), Request("qc", {}, {}, {"a": 1}, {}, {})
    assert points.problem(req) == "MISSING_MANIFEST"
    points.begin(req)
    assert points.problem(req) == "NON_COMPLETE_STATUS"
    points.state_path("qc").mkdir()
    (points.state_path("qc") / "x.parquet").write_bytes(b"1")
    (tmp_path / "out.tsv").write_text("x")
    points.complete(req, ["out.tsv"])
    assert points.problem(req) is None
    assert points.problem(Request("qc", {}, {}, {"a": 2}, {}, {})) == "FINGERPRINT_MISMATCH"
    (tmp_path / "out.tsv").write_text("y")
    assert points.problem(req) == "OUTPUT_HASH_MISMATCH"
    (tmp_path / "out.tsv").unlink()
    assert points.problem(req) == "MISSING_OUTPUT"
    points.manifest_path("qc").write_text("{")
    assert points.problem(req) == "INVALID_MANIFEST"


def test_command_line(tmp_path, capsys):
    assert cli.main(["doctor"]) == 0 and "spark" in capsys.readouterr().out
    cli.main(["guided", "prepare", "--target", "T", "--non-target", "N", "--workspace", str(tmp_path)])
    c = config.load(str(tmp_path / "config-proposal.yaml"))
    assert c.panel.proposal["non_targets"][0]["name"] == "N" and c.primer_design.assays_per_region == 3
    assert cli.main(["panel", "approve", str(tmp_path / "panel_proposal.yaml"), "--output", str(tmp_path / "m.json")]) == 0
    c = config.load(cli.guided_finalize("T", str(tmp_path), str(tmp_path / "m.json"), Archive(4)))
    assert c.off_targets[0].name == "N" and c.contrastive_conservation.enabled and ncbi.validate_frozen(c.off_targets[0].frozen_dataset)["consolidated"]["record_count"] == 4
    told = json.loads((tmp_path / "guided_acquisition_manifest.json").read_text())
    assert told["datasets"][0]["record_count"] == 4
    with pytest.raises(ValueError, match="another target"):
        cli.guided_finalize("U", str(tmp_path), str(tmp_path / "m.json"), Archive(4))
    with pytest.raises(ValueError, match="no suggestions"):
        cli.guided_config("T")
    assert len(cli.guided_config("west nile VIRUS")["off_targets"]) == 3
    capsys.readouterr()
    assert cli.main(["run", str(tmp_path / "config-approved.yaml"), "--dry-run", "--outdir", str(tmp_path / "none")]) == 0
    dry = json.loads(capsys.readouterr().out)
    assert dry["needs_network"] and dry["stages"]["qc"] == {"action": "RUN", "checkpoint": "MISSING_MANIFEST"} and not (tmp_path / "none").exists()


def test_streams(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([(i, f"s{i}", "ACGTACGTAC", "AC-T")], "ordinal long, sequence_id string, sequence string, aligned_sequence string").write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("ordinal long, sequence_id string, sequence string, aligned_sequence string").parquet(str(tmp_path / "in/*"))
    hits = arrivals.stream_hits(stream, [Oligo("a", "PROBE", "GTAC")], SpecificityConfig(), ["sequence_id"])
    q = hits.writeStream.format("memory").queryName("arrived").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("arrived").where("exact_match").groupBy("sequence_id").count().count() == 2
    q = arrivals.accumulate_votes(stream, str(tmp_path / "votes"), str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = {r.alignment_position: (r.depth, r.votes_A) for r in arrivals.votes(spark, str(tmp_path / "votes")).collect()}
    assert got[1] == (2, 24) and got[3] == (0, 0)


# data sources -------------------------------------------------------------------------------------


def test_records_of_splits_are_each_read_once():
    import io

    from strandweave.sources import data_source

    text = b"; a note\n>a one\nAC>GT\n\n>b\n>c\r\nNN\r\n" + b">long " + b"x" * 50 + b"\n" + b"ACGT\n" * 200 + b">last"
    whole = list(data_source.records(io.BytesIO(text), 0, len(text), b">"))
    assert [t.split(b"\n")[0].strip()[:5] for _, t in whole] == [b">a on", b">b", b">c", b">long", b">last"]
    assert b"".join(t for _, t in whole) == text[text.index(b">a") :] and all(text[p : p + len(t)] == t for p, t in whole)
    for size in (1, 2, 3, 7, 20, 64, 333):
        parts = [list(data_source.records(io.BytesIO(text), a, min(len(text), a + size), b">")) for a in range(0, len(text), size)]
        assert [r for p in parts for r in p] == whole


def test_formats_read_what_the_readers_read(spark, tmp_path):
    from strandweave.sources import data_source

    data_source.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.fasta").write_text(">s1 first one\nacgt\nNNAC\n>s2\n\n" + ">s3 x\n" + "ACGTACGTAC\n" * 40)
    (folder / "b.fasta").write_text(">s4\r\nAC GT\r\n")
    (folder / "_c.fasta").write_text(">hidden\nA\n")
    (folder / "empty.fasta").write_text("")
    columns = ("sequence_id", "description", "sequence")
    want = sorted(map(tuple, fasta.read(spark, str(folder / "[ab].fasta")).select(*columns).collect()))
    for size in (16, 1 << 20):
        rows = spark.read.format("fasta").option("splitBytes", size).load(str(folder))
        assert sorted(map(tuple, rows.select(*columns).collect())) == want and rows.select("file", "place").distinct().count() == 4
    assert spark.read.format("fasta").option("splitBytes", 16).load(str(folder)).rdd.getNumPartitions() > 5
    record = "LOCUS       {0}\nDEFINITION  Some {0}.\nVERSION     {0}.1\nFEATURES             Location/Qualifiers\n     gene            1..3\n                     /gene=\"g\"\nORIGIN\n        1 acgtac\n//\n"
    (tmp_path / "r.gb").write_text("".join(record.format(f"G{i}") for i in range(9)))
    want = [(r.sequence_id, r.sequence, r.description, r.features) for r in genbank.read(spark, str(tmp_path / "r.gb")).orderBy("ordinal").collect()]
    rows = spark.read.format("genbank").option("splitBytes", 100).load(str(tmp_path / "r.gb")).orderBy("place")
    assert [(r.sequence_id, r.sequence, r.description, r.features) for r in rows.collect()] == want and len(want) == 9
    with pytest.raises(Exception, match="nowhere"):
        spark.read.format("fasta").load(str(tmp_path / "nowhere")).collect()


def test_arriving_files_are_read_once(spark, tmp_path):
    import os

    from strandweave.sources import data_source

    data_source.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive(name, text, at):
        (tmp_path / "new").write_text(text)
        os.utime(tmp_path / "new", (at, at))
        os.rename(tmp_path / "new", folder / name)

    def run():
        stream = spark.readStream.format("fasta").option("splitBytes", 12).load(str(folder))
        hits = arrivals.stream_hits(stream, [Oligo("a", "PROBE", "GTAC")], SpecificityConfig(max_probe_mismatches=0), ["sequence_id"])
        q = hits.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((r.sequence_id, r.orientation) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive("b.fa", ">s1\nAAGTACAA\n>s2\nCCCC\n", 1_000)
    both = lambda *names: sorted((n, o) for n in names for o in ("FORWARD", "REVERSE_COMPLEMENT"))
    assert run() == both("s1")
    arrive("a.fa", ">s3\nTTGTACTT\n", 2_000)
    assert run() == both("s1", "s3")
    assert run() == both("s1", "s3")
