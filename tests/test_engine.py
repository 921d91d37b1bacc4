"""Golden values and failure behaviour of the comparison engine on small fixtures."""

from __future__ import annotations

import gzip
import itertools
import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandloom import cli
from strandloom.api import ModeError, open_database
from strandloom.functions import histogram, names
from strandloom.operators import cluster, codec, compare, contract, matrix, packing, registry, views
from strandloom.plans import adapters
from strandloom.sources import config, ingest, reference, sinks
from strandloom.sources.store import Store
from strandloom.streaming import sync

from .conftest import DATA

POSITION = "sample_id string, chrom string, pos bigint, genome string, gene string, A int, C int, G int, T int"
G = "GCF_000001.1"
S1 = [("contigA", 1, 5, 0, 0, 0), ("contigA", 2, 0, 0, 0, 5), ("contigA", 3, 0, 3, 3, 0), ("contigA", 4, 0, 0, 5, 0), ("contigA", 5, 5, 0, 0, 0), ("contigA", 9, 0, 0, 0, 4), ("contigB", 1, 0, 0, 5, 0), ("contigB", 2, 0, 0, 4, 0), ("contigB", 3, 0, 5, 0, 0)]
S2 = [("contigA", 1, 5, 0, 0, 0), ("contigA", 2, 0, 0, 0, 5), ("contigA", 3, 0, 5, 0, 0), ("contigA", 4, 5, 0, 0, 0), ("contigA", 5, 0, 0, 0, 5), ("contigB", 1, 0, 0, 5, 0), ("contigB", 3, 0, 0, 0, 5)]
S3 = [("contigA", 1, 4, 0, 0, 0), ("contigB", 1, 0, 0, 4, 0)]


def positions(spark, **samples):
    rows = [(s, c, p, G, None, a, cc, g, t) for s, each in samples.items() for c, p, a, cc, g, t in each]
    return spark.createDataFrame(rows, POSITION)


@pytest.fixture()
def mask_fixture(spark):
    fasta = spark.createDataFrame([("contigA", "ATCGNATCGT"), ("contigB", "GGCAT")], "chrom string, sequence string")
    stb = spark.createDataFrame([("contigA", G), ("contigB", G)], "scaffold string, genome string")
    bed = spark.createDataFrame([("contigA", 0, 10), ("contigB", 0, 5)], "chrom string, start_pos bigint, end_pos bigint")
    return positions(spark, S1=S1, S2=S2, S3=S3), fasta, stb, bed


def test_codec_packs_masks_of_odd_length():
    values = np.array([0, 1, 2, 4, 8, 15, 3], np.uint8)
    assert codec.unpack_nibbles(codec.pack_nibbles(values), 7).tolist() == values.tolist()
    flags = np.array([1, 0, 1, 1, 0, 0, 0, 0, 1], bool)
    assert codec.unpack_bits(codec.pack_bits(flags), 9).tolist() == flags.tolist()
    assert codec.pack_bits(np.array([1, 0, 0, 0, 0, 0, 0, 0], bool)) == b"\x01"


def test_masks_survive_encoding_and_short_coverage_makes_no_block(spark, mask_fixture):
    rows, fasta, stb, _ = mask_fixture
    segments = codec.reference_segments(fasta, stb)
    assert segments.count() == 2
    blocks = codec.encode(rows, segments)
    assert {r.sample_id for r in blocks.collect()} == {"S1", "S2"}
    want = {tuple(r) for r in matrix.covered(rows).select("sample_id", "genome", "chrom", "pos", "mask").collect()}
    assert {tuple(r) for r in codec.decode(blocks, segments).collect()} == want


def test_a_damaged_block_is_refused(spark, mask_fixture):
    rows, fasta, stb, _ = mask_fixture
    segments = codec.reference_segments(fasta, stb)
    bad = codec.encode(rows, segments).withColumn("payload_hash", F.lit("0"))
    with pytest.raises(Exception, match="does not match its hash"):
        codec.decode(bad, segments).collect()


def test_popani_of_both_kernels(spark, mask_fixture):
    rows, _, stb, bed = mask_fixture
    got = compare.pairs(rows).collect()
    assert [(r.sample_1, r.sample_2, r.total_positions, r.share_allele_pos) for r in got] == [("S1", "S2", 7, 4)]
    assert got[0].genome_ani == pytest.approx(400 / 7)
    assert [tuple(r) for r in compare.joined_pairs(rows).collect()] == [tuple(r) for r in got]
    packed = compare.packed_pairs(matrix.bitmask(rows, contract.axis(bed, stb)), samples_per_block=1, cells_per_block=4).collect()
    assert [tuple(r) for r in packed] == [tuple(r) for r in got]


@pytest.mark.parametrize("method", ["popani", "conani", "cosani_0.9"])
def test_packed_kernels_equal_the_join(spark, method):
    rng = np.random.default_rng(5)
    rows = [(f"s{i}", f"c{p % 2}", int(p), G, f"g{p // 7}", *map(int, rng.integers(0, 6, 4))) for i in range(9) for p in range(40) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, POSITION)
    plain = sorted(map(tuple, compare.joined_pairs(df, method).collect()))
    key = ["genome", "sample_1", "sample_2"]
    got = compare.packed(compare.alleles(df, method), method, samples_per_block=4, cells_per_block=8)
    assert sorted(tuple(r) for r in got.collect()) == [r[:5] for r in plain]
    # some pairs are there already: the others come, and two old samples do not meet again
    old = compare.joined_pairs(df.filter("sample_id < 's6'"), method).select(*key)
    done = old.filter("sample_1 <> 's1' or sample_2 <> 's3'")
    assert sorted(r.sample_id for r in compare.open_samples(df, old).collect()) == ["s6", "s7", "s8"]
    want = [r for r in plain if r[2] > "s5" or r[1:3] == ("s1", "s3")]
    assert sorted(map(tuple, compare.missing_pairs(compare.alleles(df, method), done, method, samples_per_block=2).collect())) == want
    if method == "popani":
        plain_runs = {}
        for a, b in itertools.combinations(sorted({r[0] for r in rows}), 2):
            own = {s: {(r[1], r[2]): sum(x for x, c in ((1, r[5]), (2, r[8]), (4, r[6]), (8, r[7])) if c) for r in rows if r[0] == s and sum(r[5:9]) >= 5} for s in (a, b)}
            best = run = 0
            for c in ("c0", "c1"):
                run = 0
                for p in range(41):
                    run = run + 1 if own[a].get((c, p), 0) & own[b].get((c, p), 0) else 0
                    best = max(best, run)
            plain_runs[a, b] = best
        for size in (3, 4096):
            assert {(r.sample_1, r.sample_2): r.max_consecutive_length for r in compare.longest_runs(df, samples_per_block=4, cells_per_block=size).collect()} == plain_runs


def test_mask_projects_need_references_and_whole_counts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "p"))
    store.set_contract("allele_mask", 3)
    store.add_runs(["r1", "r2"])
    write_bundle(tmp_path, "r1")
    files = [str(tmp_path / f"r1.{x}") for x in ("parquet", "genome_stats.parquet", "sylph.csv")]
    with pytest.raises(ValueError, match="reference segments"):
        store.import_bundle("r1", *files)
    fasta = lambda chrom: spark.createDataFrame([(chrom, "ACGTACGTAC")], "chrom string, sequence string")
    stb = lambda chrom: spark.createDataFrame([(chrom, "genome_a")], "scaffold string, genome string")
    other = Store(spark, str(tmp_path / "q"))
    other.set_contract("allele_mask", 3)
    other.add_runs(["r1"])
    with pytest.raises(Exception, match="without a reference"):
        other.import_bundle("r1", *files, segments=codec.reference_segments(fasta("elsewhere"), stb("elsewhere")))
    assert other.table("samples").count() == 0
    (tmp_path / "g.fna").write_text(">contigA\nACGTACGTAC\n")
    cli.main([str(tmp_path / "p"), "references-set", "--genome-fasta", f"genome_a={tmp_path / 'g.fna'}"], spark)
    store.import_bundle("r1", *files)
    assert sorted((r.pos, r.mask) for r in store.masks().collect()) == [(1, 1), (2, 4)]
    part = pd.read_parquet(tmp_path / "r1.parquet")
    part.assign(A=[4.5, 0]).to_parquet(tmp_path / "r2.parquet")
    with pytest.raises(Exception, match="out of range"):
        store.import_bundle("r2", str(tmp_path / "r2.parquet"), *files[1:])
    (tmp_path / "x.bed").write_text("contigA\t0\t10\n")
    (tmp_path / "x.stb").write_text("contigA\tgenome_a\n")
    build = [str(tmp_path / "p"), "matrix-sync-build", str(tmp_path / "m"), "--bed", str(tmp_path / "x.bed"), "--stb", str(tmp_path / "x.stb")]
    cli.main(build, spark)
    cli.main(build, spark)
    assert sorted((r.axis_pos, r["mask"]) for r in store.matrix_cells(str(tmp_path / "m")).collect()) == [(0, 1), (1, 4)]
    for _ in range(2):  # the first time there is nothing to read
        cli.main([str(tmp_path / "p"), "matrix-sync-compare", str(tmp_path / "c")], spark)
    cli.main([str(tmp_path / "p"), "matrix-compare", str(tmp_path / "m"), str(tmp_path / "o")], spark)
    assert store.table("matrix_compares").count() == 1
    with pytest.raises(ValueError, match="holds no counts"):
        cli.main([str(tmp_path / "p"), "matrix-compare", str(tmp_path / "m"), str(tmp_path / "o2"), "--method", "conani"], spark)
    with pytest.raises(ValueError, match="not of kind counts"):
        cli.main([*build, "--storage-mode", "counts"], spark)
    bad = spark.createDataFrame([(1, "allele_mask", 1, 3, "lz4", "ATCG")], "id int, mode string, format_version int, min_cov int, codec string, allele_bit_order string")
    store.replace({"profile_storage": bad})
    with pytest.raises(ValueError, match="profile storage"):
        store.masks()


def test_matrices_of_counts_are_built_and_compared_by_every_metric(spark, tmp_path):
    store = Store(spark, str(tmp_path / "p"))
    store.set_contract("full")
    store.add_runs(["r1", "r2"])
    for run in ("r1", "r2"):
        write_bundle(tmp_path, run)
    rows = pd.DataFrame({"chrom": ["contigA"] * 3, "pos": [1, 2, 4], "genome": ["genome_a"] * 3, "gene": ["contigA_1"] * 3})
    rows.assign(A=[9, 0, 0], C=[0, 6, 1], G=[0, 4, 9], T=0).to_parquet(tmp_path / "r1.parquet")
    rows.assign(A=[9, 0, 0], C=[0, 4, 9], G=[0, 6, 0], T=0).to_parquet(tmp_path / "r2.parquet")
    for run in ("r1", "r2"):
        store.import_bundle(run, *[str(tmp_path / f"{run}.{x}") for x in ("parquet", "genome_stats.parquet", "sylph.csv")])
    (tmp_path / "x.bed").write_text("contigA\t0\t10\n")
    (tmp_path / "x.stb").write_text("contigA\tgenome_a\n")
    (tmp_path / "x.genes").write_text("contigA_1\tcontigA\t1\t2\n")
    axis = ["--bed", str(tmp_path / "x.bed"), "--stb", str(tmp_path / "x.stb")]
    cli.main([str(tmp_path / "p"), "matrix-sync-build", str(tmp_path / "m"), *axis, "--storage-mode", "counts"], spark)
    assert store.table("matrix_stores").first().storage_layout == "counts"
    assert sorted((r.sample_id, r.axis_pos, r.A, r.T, r.C, r.G) for r in store.matrix_cells(str(tmp_path / "m")).collect())[:2] == [("r1", 0, 9, 0, 0, 0), ("r1", 1, 0, 0, 6, 4)]
    compare_all = [str(tmp_path / "p"), "matrix-compare", str(tmp_path / "m")]
    cli.main([*compare_all, str(tmp_path / "pop"), "--calculate", "all", "--gene-ranges", str(tmp_path / "x.genes"), *axis], spark)
    read = lambda path: spark.read.parquet(str(tmp_path / path)).first()
    assert (read("pop/ani").total_positions, read("pop/ani").share_allele_pos) == (3, 3)
    assert (read("pop/gene").gene, read("pop/gene").total_positions) == ("contigA_1", 2)
    assert read("pop/ibs").max_consecutive_length == 2
    cli.main([*compare_all, str(tmp_path / "con"), "--method", "conani"], spark)
    assert (read("con").total_positions, read("con").share_allele_pos) == (3, 1)
    assert {r.calculate for r in store.table("matrix_compares").collect()} == {"all", "ani"}
    with pytest.raises(ValueError, match="unknown calculation"):
        cli.main([*compare_all, str(tmp_path / "x"), "--calculate", "ani+other"], spark)
    with pytest.raises(ValueError, match="places on the axis"):
        cli.main([*compare_all, str(tmp_path / "x"), "--calculate", "gene"], spark)


def test_of_two_writers_the_second_fails_and_readers_see_the_first(spark, tmp_path):
    store = Store(spark, str(tmp_path / "p"))
    store.set_contract("full")
    first, second = store.state(), store.state()
    store.commit(first | {"samples": {"a": {}}})
    with pytest.raises(OSError, match="another writer"):
        store.commit(second | {"samples": {"b": {}}})
    assert store.state()["samples"] == {"a": {}}
    for _ in range(7):
        store.commit(store.state())
    assert len(store._numbers()) == 5 and store.state()["samples"] == {"a": {}}
    for n in store._numbers():
        store.files.delete(f"{store.root}/state/{n}.json")
    with pytest.raises(OSError, match="no state"):
        store.state()


def test_rows_of_another_project_and_appended_pointers(spark, tmp_path):
    a, b = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    a.add_runs(["x", "y"])
    b.add_runs(["y", "z"])
    assert a.copy_rows(b, ["sra_runs"]) == {"sra_runs": 1} and a.table("sra_runs").count() == 3
    ends = "genome string, sample_id string, sample_idx bigint, row_end bigint"
    old, new = spark.createDataFrame([("g", "a", 0, 3), ("g", "b", 1, 5)], ends), spark.createDataFrame([("g", "c", 0, 2), ("h", "c", 0, 4)], ends)
    assert sorted(map(tuple, matrix.appended_pointers(old, new).collect())) == [("g", "a", 0, 3), ("g", "b", 1, 5), ("g", "c", 2, 7), ("h", "c", 0, 4)]


def test_longest_run_stops_at_scaffolds_and_gaps(spark, mask_fixture):
    assert [r.max_consecutive_length for r in compare.longest_runs(mask_fixture[0]).collect()] == [3]


def test_axis_has_separators(spark, mask_fixture):
    _, _, stb, bed = mask_fixture
    axis = contract.axis(bed, stb)
    assert [(r.chrom, r.scaffold_ordinal, r.index_base, r.axis_start) for r in axis.orderBy("chrom").collect()] == [("contigA", 0, 1, 0), ("contigB", 1, 1, 11)]
    assert contract.lengths(axis).first().asDict() == {"genome": G, "true_length": 15, "matrix_length": 16, "genome_idx": 0}
    with pytest.raises(ValueError, match="without intervals"):
        contract.axis(bed.filter("chrom = 'contigA'"), stb)


def test_sparse_and_count_matrices(spark):
    rows = positions(spark, sample_a=[("contigA", 1, 5, 0, 0, 0), ("contigA", 2, 0, 3, 0, 0)])
    axis = contract.axis(spark.createDataFrame([("contigA", 0, 10)], "chrom string, start_pos bigint, end_pos bigint"), spark.createDataFrame([("contigA", G)], "scaffold string, genome string"))
    catalog = spark.createDataFrame([(G, "sample_a"), (G, "sample_b")], "genome string, sample_id string")
    m = matrix.bitmask(rows, axis)
    assert [(r.axis_pos, r.mask) for r in m.collect()] == [(0, 1)]
    assert [r.row_end for r in matrix.row_pointers(m, catalog).orderBy("sample_idx").collect()] == [1, 1]
    counts = matrix.counts(rows, axis, 3).orderBy("axis_pos").collect()
    assert [[r.A, r["T"], r.C, r.G] for r in counts] == [[5, 0, 0, 0], [0, 0, 3, 0]]
    assert [(r.cell, r.value) for r in matrix.flat_counts(matrix.counts(rows, axis, 3)).orderBy("cell").collect()] == [(0, 5), (6, 3)]
    assert [r.vector for r in matrix.dense(m, catalog, contract.lengths(axis)).orderBy("sample_id").collect()] == [[1] + [0] * 9, [0] * 10]
    assert matrix.zero_rows(m, catalog).first().sample_id == "sample_b"
    with pytest.raises(ValueError, match="already stored"):
        matrix.append_rows(catalog.limit(1), catalog, catalog)
    assert matrix.append_rows(spark.createDataFrame([(G, "sample_c")], catalog.schema), catalog, catalog).first().sample_idx == 2


@pytest.mark.parametrize(("mode", "dtype", "want"), [(None, None, "bitmask"), (None, "uint16", "counts"), ("counts", None, "counts")])
def test_storage_mode(mode, dtype, want):
    assert matrix.storage_mode(mode, dtype) == want


def test_bitmask_refuses_a_count_type():
    with pytest.raises(ValueError):
        matrix.storage_mode("bitmask", "uint16")


def edges(spark, pairs, ani=99.9, total=20000):
    return spark.createDataFrame([("g", a, b, total, ani) for a, b in pairs], "genome string, sample_1 string, sample_2 string, total_positions bigint, genome_ani double")


def test_connectivity_by_fraction_and_by_samples(spark):
    results = edges(spark, ["ab", "ac", "ad", "bc", "bd", "cd", "ae", "bf"])
    pairs = views.qualifying(results, 10_000)
    keep = lambda **k: sorted(r.sample_id for r in views.retained(pairs, **k).collect())
    assert keep(max_null_fraction=0.4) == ["a", "b", "c", "d"]
    assert keep(max_null_fraction=1.0, max_null_samples=1) == ["a", "b"]


def test_condensed_order_and_bytes(spark, monkeypatch):
    results = spark.createDataFrame([("g", "a", "b", 120000, 99.95), ("g", "a", "c", 110000, 99.80), ("g", "c", "b", 100000, 99.90)], "genome string, sample_1 string, sample_2 string, total_positions bigint, genome_pop_ani double")
    pairs = views.qualifying(results, 10_000)
    cells = views.condensed(pairs, views.retained(pairs))
    assert [round(r.ani, 2) for r in cells.orderBy("k").collect()] == [99.95, 99.8, 99.9]
    for size in (1, 2, sinks.CELLS):
        monkeypatch.setattr(sinks, "CELLS", size)
        assert np.frombuffer(gzip.decompress(b"".join(sinks.condensed_bytes(cells, "total_positions", "<u8"))), "<u8").tolist() == [120000, 110000, 100000]
    merges = cluster.merge_rows(views.condensed(pairs, views.retained(pairs))).orderBy("merge_id").collect()
    assert [r.merge_id for r in merges] == [3, 4]


def brute_linkage(d, method):
    groups = {i: [i] for i in range(len(d))}
    heights, dist = [], {(i, j): d[i, j] for i, j in itertools.combinations(range(len(d)), 2)}
    n = len(d)
    while len(groups) > 1:
        (a, b), h = min(dist.items(), key=lambda x: x[1])
        heights.append(h)
        new = n
        n += 1
        for c in groups:
            if c in (a, b):
                continue
            x, y = dist[tuple(sorted((a, c)))], dist[tuple(sorted((b, c)))]
            na, nb = len(groups[a]), len(groups[b])
            dist[tuple(sorted((c, new)))] = {"single": min(x, y), "complete": max(x, y), "average": (na * x + nb * y) / (na + nb), "weighted": (x + y) / 2}[method]
        groups[new] = groups.pop(a) + groups.pop(b)
        dist = {k: v for k, v in dist.items() if a not in k and b not in k}
    return heights


@pytest.mark.parametrize("method", cluster.METHODS)
def test_linkage_heights_match_the_naive_algorithm(method):
    rng = np.random.default_rng(3)
    for n in (2, 3, 9, 30):
        d = rng.random((n, n))
        d = (d + d.T) / 2
        np.fill_diagonal(d, 0)
        got = cluster.linkage(d, method)
        assert np.allclose(got[:, 2], brute_linkage(d, method))
        assert (got[:, 0] < got[:, 1]).all() and got[-1, 3] == n
        assert sorted(cluster.leaves(got)) == list(range(n))
        assert len(set(cluster.flat(got, -1.0))) == n and set(cluster.flat(got, 2.0)) == {1}


def test_histograms(spark):
    df = spark.createDataFrame([(95.0,), (100.0,), (94.0,), (float("nan"),), (None,)], "x double")
    assert {r.bin: r.n for r in histogram.fixed_histogram(df, "x", 95.0, 100.0, 250).filter("n > 0").collect()} == {0: 1, 249: 1}
    one = histogram.auto_histogram(spark.createDataFrame([(7.0,), (7.0,)], "x double"), "x", 10).first()
    assert (one.lo, one.hi, one.n, one.bin) == (6.5, 7.5, 2, 5)


def test_names(spark):
    df = spark.createDataFrame([("db/GCF_901875305.1_genomic.fna.gz",), ("gcf_1",), (None,)], "p string")
    assert [r.a for r in df.select(names.accession(F.col("p")).alias("a")).collect()] == ["GCF_901875305.1", None, None]
    assert names.normalized([" a", "b", "", "a "]) == ["a", "b"]


def test_reference_files(spark, tmp_path):
    (tmp_path / "g.fna").write_text(">g1 whole\nAC\nGT\n")
    (tmp_path / "g.ffn").write_text(">g1_1 # 1 # 4 # 1 # ID=1\nACGT\n")
    made = reference.derive(spark, {"GCF_1": str(tmp_path / "g.fna")}, {"GCF_1": str(tmp_path / "g.ffn")})
    assert [tuple(r) for r in made["stb"].collect()] == [("g1", "GCF_1")]
    assert [tuple(r) for r in made["bed"].collect()] == [("g1", 0, 4)]
    assert [tuple(r) for r in made["gene_ranges"].collect()] == [("g1_1", "g1", 1, 4)]
    assert [r.sequence for r in made["fasta"].collect()] == ["ACGT"]


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text("[genome_view]\nmax_null_samples = 3\nneighbor_k = 4\n")
    c = config.load(str(tmp_path / "c.toml"))
    assert (c.view.max_null_samples, c.view.neighbor_k) == (3, 4)
    assert config.over(c, max_null_fraction=0.5).view.max_null_samples is None
    with pytest.raises(ValueError, match="neighbor_k"):
        config.parse({"genome_view": {"neighbor_k": 0}})


def write_bundle(folder, run, *, bad=False):
    pd.DataFrame({"chrom": ["contigA"] * 2, "genome": ["genome_a"] * 2, "pos": [1, 2], "gene": ["gene1", None], "A": [5.0, 0], "C": [0.0, 70000 if bad else 3], "G": [0.0, 0], "T": [0.0, 0], "ref_base_bitmask": [1, 2]}).to_parquet(folder / f"{run}.parquet")
    pd.DataFrame({"genome": ["genome_a"], "cov": [2.0], "breadth": [0.9], "genome_length": [10], "BER": [0.8]}).to_parquet(folder / f"{run}.genome_stats.parquet")
    pd.DataFrame({"genome": ["genome_a"], "gene": ["gene1"], "length": [2], "coverage": [2.0]}).to_parquet(folder / f"{run}.gene_stats.parquet")
    pd.DataFrame({"genome": ["genome_a"], "accession": ["GCF_1"], "abundance": [0.1]}).to_csv(folder / f"{run}.sylph.csv", index=False)


def test_project_from_runs_to_views(spark, tmp_path):
    store = Store(spark, str(tmp_path / "p"))
    assert store.add_runs([" r1", "r2", "r3", "r1"]) == {"added": 3, "reactivated": 0}
    assert store.delete_runs(["r3"]) == 1 and store.delete_runs(["r3"]) == 0
    write_bundle(tmp_path, "r1")
    write_bundle(tmp_path, "r2", bad=True)
    outcome = {r.run_id: r.outcome for r in sync.profiles(store, str(tmp_path)).collect()}
    assert outcome == {"r1": "imported", "r2": "failed"}
    db = open_database(spark, str(tmp_path / "p"))
    assert [r.sample_id for r in db.samples().collect()] == ["r1"]
    got = db.sample("r1").profile().lazy().orderBy("pos").collect()
    assert [(r.A, r.C, r.gene) for r in got] == [(5, 0, "gene1"), (0, 3, None)]
    assert db.genome("genome_a").genome_stats().collect()[0].ber == 0.8
    assert [r.genome for r in db.genomes("nome").collect()] == ["genome_a"]
    assert db.genome("GCF_1").sylph_abundance().lazy().count() == 1
    with pytest.raises(ValueError):
        db.genome(" ")
    # a failed import leaves nothing behind, a second one of the same sample replaces it
    assert store.table("profile_positions").count() == 2
    write_bundle(tmp_path, "r2")
    assert {r.outcome for r in sync.profiles(store, str(tmp_path)).collect()} == {"imported"}
    store.import_bundle("r1", *[str(tmp_path / f"r1.{x}") for x in ("parquet", "genome_stats.parquet", "sylph.csv")])
    assert store.table("profile_positions").count() == 4
    assert store.add_runs(["r3"]) == {"added": 0, "reactivated": 1}
    with pytest.raises(ValueError, match="cannot change"):
        store.set_contract("allele_mask")
    sinks.to_parquet(db.sample("r1").profile().lazy(), str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        db.sample("r1").profile().sink_parquet(str(tmp_path / "out"))
    sinks.per_sample(store.table("profile_positions"), str(tmp_path / "each"))
    assert spark.read.parquet(str(tmp_path / "each")).filter("gene = 'NA'").count() == 2
    status = registry.status(*[store.table(t) for t in ("sra_runs", "samples", "profile_positions", "mask_blocks", "matrix_stores", "matrix_compares")]).first()
    assert (status.active_runs, status.complete_samples, status.remaining_profiles) == (3, 2, 1)
    # matrices, comparison and views, twice: the second time there is nothing to do
    axis = contract.axis(spark.createDataFrame([("contigA", 0, 10)], "chrom string, start_pos bigint, end_pos bigint"), spark.createDataFrame([("contigA", "genome_a")], "scaffold string, genome string"))
    wanted = store.table("genome_stats").select("genome", "sample_id").distinct()
    held = store.table("matrix_store_samples")
    m = str(tmp_path / "m")
    # a build that dies before its commit leaves nothing that is read
    sync.matrices(matrix.bitmask(store.table("profile_positions"), axis), wanted, held, m)
    with pytest.raises(FileNotFoundError):
        store.matrix_cells(m)
    assert sync.build(store, axis, m, min_coverage=1.0).first().outcome == "built"
    assert sync.build(store, axis, m).first().outcome == "up_to_date"
    row = store.table("matrix_stores").first()
    assert (row.matrix_id, row.profile_count, row.min_coverage) == ("genome_a", 2, 1.0) and store.matrix_cells(m).count() == 2
    results = compare.packed_pairs(store.matrix_cells(m))
    assert [(r.total_positions, r.share_allele_pos, r.genome_ani) for r in results.collect()] == [(1, 1, 100.0)]
    assert [(r.total_positions, r.share_allele_pos, r.genome_ani) for r in compare.pairs(store.table("profile_positions"), "conani").collect()] == [(1, 1, 100.0)]
    options = config.ViewOptions(min_comp_len=0)
    view = lambda: [r.outcome for r in sync.genome_views(store, results, wanted, store.table("genome_stats"), store.table("sylph_abundance"), str(tmp_path / "v"), options).collect()]
    assert view() == ["built"] and view() == ["up_to_date"]
    assert len(json.loads((tmp_path / "v/catalog.json").read_text())["genomes"]) == 1
    at = tmp_path / "v/genome=genome_a"
    assert json.loads((at / "samples.json").read_text())["samples"] == ["r1", "r2"]
    assert json.loads((at / "manifest.json").read_text())["strain_clusters"] == 1
    assert [(n["strain_cluster"], n["clonal_cluster"]) for n in json.loads((at / "neighbor_network.json").read_text())["nodes"]] == [(1, 1), (1, 1)]
    assert [(r["leaf_rank"], r["sample_id"], r["ber"]) for r in json.loads((at / "sample_stats.json").read_text())["rows"]] == [(0, "r1", 0.8), (1, "r2", 0.8)]
    (at / "clusters.json").unlink()  # a view without one of its files is built again
    assert view() == ["built"]
    assert json.loads((at / "dendrogram.json").read_text())["root_id"] == 2
    assert np.frombuffer(gzip.decompress((at / "similarity_ani.condensed.f32.gz").read_bytes()), "<f4").tolist() == [100.0]
    # to masks
    target = Store(spark, str(tmp_path / "masks"))
    segments = codec.reference_segments(spark.createDataFrame([("contigA", "ACGTACGTAC")], "chrom string, sequence string"), spark.createDataFrame([("contigA", "genome_a")], "scaffold string, genome string"))
    assert store.migrate(target, segments) == {"done": 2, "failed": 0}
    assert store.migrate(target, segments) == {"done": 0, "failed": 0}
    assert target.masks().count() == 2
    assert sync.build(target, axis, str(tmp_path / "mm")).first().outcome == "built"
    cells = lambda s, at: sorted(map(tuple, s.matrix_cells(str(tmp_path / at)).select("genome", "sample_id", "axis_pos", "mask").collect()))
    assert cells(target, "mm") == cells(store, "m")
    with pytest.raises(ValueError, match="coverage of 5"):
        sync.build(target, axis, str(tmp_path / "mm"), min_cov=3)
    with pytest.raises(ModeError):
        open_database(spark, str(tmp_path / "masks")).sample("r1").profile()


def test_commands(spark, tmp_path, capsys):
    project = str(tmp_path / "p")
    cli.main([project, "init"], spark)
    cli.main([project, "runs-add", "x", "y"], spark)
    assert json.loads(capsys.readouterr().out) == {"added": 2, "reactivated": 0}
    cli.main([project, "profiles-remaining"], spark)
    assert [json.loads(x)["run_id"] for x in capsys.readouterr().out.split("\n") if x] == ["x", "y"]
    cli.main([project, "status"], spark)
    assert json.loads(capsys.readouterr().out)["remaining_profiles"] == 2


def test_sample_catalog_of_three_layouts(spark):
    rows = spark.createDataFrame([("g", "b", "a", 4, 2), ("g", "c", "a", 9, 2), ("g", "c", "z", 9, 4)], "genome string, sample_1 string, sample_2 string, sample_idx_1 int, sample_idx_2 int")
    named = lambda *a: sorted(map(tuple, views.sample_catalog(*a).collect()))
    assert named(rows) == [(2, "a"), (4, "b"), (9, "c")]
    assert named(rows.drop("sample_idx_1", "sample_idx_2")) == [(0, "a"), (1, "b"), (2, "c"), (3, "z")]
    assert named(rows, spark.createDataFrame([(7, "q")], "sample_idx bigint, sample_name string")) == [(7, "q")]


def test_statistics_in_leaf_order_are_one_row_a_sample(spark):
    clusters = spark.createDataFrame([("g", "a", 1), ("g", "b", 0)], "genome string, sample_id string, leaf_rank bigint")
    stats = spark.createDataFrame([("g", "a", 1.0), ("g", "x", 2.0), ("g", "x", 2.0)], "genome string, sample_id string, ber double")
    assert [(r.sample_id, r.ber) for r in views.in_leaf_order(clusters, stats).orderBy("leaf_rank").collect()] == [("b", None), ("a", 1.0)]
    with pytest.raises(ValueError, match="more than one row"):
        views.in_leaf_order(clusters, stats.unionByName(stats))


def test_imported_files_are_deleted_once_all_are_in(spark, tmp_path):
    project = str(tmp_path / "p")
    cli.main([project, "init"], spark)
    cli.main([project, "runs-add", "r1", "r2"], spark)
    for run in ("r1", "r2"):
        write_bundle(tmp_path, run)
    shared = tmp_path / "r1.sylph.csv"
    pd.DataFrame([(run, str(tmp_path / f"{run}.parquet"), str(tmp_path / f"{run}.genome_stats.parquet"), None, str(shared)) for run in ("r1", "r2")], columns=["run_id", "profile_file", "genome_stats_file", "gene_stats_file", "sylph_abundance_file"]).to_csv(tmp_path / "m.csv", index=False)
    cli.main([project, "profiles-import", str(tmp_path / "m.csv"), "--delete-files"], spark)
    assert Store(spark, project).table("profile_positions").count() == 4
    assert not shared.exists() and not (tmp_path / "r2.parquet").exists() and (tmp_path / "r2.sylph.csv").exists()


def test_incomplete_comparison_is_skipped(spark):
    catalog = spark.createDataFrame([("g", s) for s in "abc"], "genome string, sample_id string")
    row = views.completeness(catalog, edges(spark, ["ab", "ba", "ac"])).first()
    assert (row.expected, row.completed, row.complete) == (3, 2, False)


def test_abundance_columns(spark):
    df = spark.createDataFrame([("a/GCF_1.fna", 0.0, 3.0), ("a/GCF_2.fna", 1.0, 0.0)], "Genome_file string, eff_cov double, other double")
    assert [r.accession for r in ingest.accession_list(df).collect()] == ["GCF_2"]
    with pytest.raises(ValueError, match="recognisable"):
        ingest.abundance(spark.createDataFrame([("x", 1.0)], "genome string, abundance double"), "s")


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    positions(spark, a=S1 + S1[:1]).write.parquet(str(source))
    q = sync.positions_stream(sync.read_profile_stream(spark, str(source), POSITION), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(S1)


@pytest.mark.parametrize("method", ["popani", "conani", "cosani_0.9"])
def test_strips_equal_the_join(spark, method, monkeypatch):
    """Positions covered by few of many samples go to strips, several a genome; a crowded genome beside them goes to tiles."""
    monkeypatch.setattr(compare, "COUNTED", 1)
    monkeypatch.setattr(compare, "STRIP", 200)
    monkeypatch.setattr(compare, "STEP", 50)
    rng = np.random.default_rng(6)
    rows = [(f"s{i}", f"c{p % 2}", int(p // 2), g, f"c{p % 2}_g{p // 9}", *map(int, rng.integers(0, 6, 4))) for g, share in (("G", 0.2), ("H", 0.9)) for i in range(24) for p in range(80) if rng.random() < share]
    rows += [(f"z{i}", "c0", p, "G", "c0_g0", *counts) for i, counts in enumerate(((9, 0, 0, 0), (0, 9, 0, 0))) for p in (0, 1)]
    df = spark.createDataFrame(rows, POSITION)
    found = compare.alleles(df, method)
    monkeypatch.setattr(compare, "TILE_COST", 1)
    plan = {r.genome: (r.listed, len(r.firsts)) for r in compare._plan(found, "chrom", 8, None, None)[0].collect()}
    assert plan["G"][0] and plan["G"][1] > 3 and not plan["H"][0]
    plain = sorted(map(tuple, compare.joined_pairs(df, method).collect()))
    for kernel in (None, "strips", "tiles"):
        assert sorted(map(tuple, compare.packed(found, method, samples_per_block=8, kernel=kernel).collect())) == [r[:5] for r in plain]
    old = compare.joined_pairs(df.filter("sample_id < 's20'"), method).select("genome", "sample_1", "sample_2")
    want = [r for r in plain if r[2] >= "s20"]
    for kernel in (None, "strips", "tiles"):
        assert sorted(map(tuple, compare.missing_pairs(found, old, method, samples_per_block=8, kernel=kernel).collect())) == want
        assert sorted(map(tuple, compare.new_pairs(found, df.filter("sample_id < 's20'").select("genome", "sample_id"), method, samples_per_block=8, kernel=kernel).collect())) == want
    if method == "popani":
        genes = df.filter("A + T + C + G >= 5").select("sample_id", "genome", "chrom", "pos", "gene").join(found, ["sample_id", "genome", "chrom", "pos"])
        by_gene = [sorted(map(tuple, compare.packed(genes, method, unit="gene", cells_per_block=None, kernel=k).select("genome", "unit", "sample_1", "sample_2", "total_positions", "share_allele_pos").collect())) for k in ("strips", "tiles")]
        assert by_gene[0] == by_gene[1] and len(by_gene[0]) > len(plain)
        runs = [sorted(map(tuple, compare.longest_runs(df, samples_per_block=8, cells_per_block=7, kernel=k).collect())) for k in (None, "strips", "tiles")]
        assert runs[0] == runs[1] == runs[2] and max(r[3] for r in runs[0]) > 3 and min(r[3] for r in runs[0]) == 0


@pytest.mark.parametrize("kernel", [None, "strips", "tiles"])
def test_pairs_above_a_number_of_positions(spark, kernel, monkeypatch):
    """Rows without a sample or a place meet none; the least overlap is asked for where sums are whole."""
    monkeypatch.setattr(compare, "COUNTED", 1)
    monkeypatch.setattr(compare, "STRIP", 20)
    rows = [(f"s{i}", "c0", p, "G", "c0_g0", 9, 0, 0, 0) for i in range(12) for p in range(30) if (i * 7 + p * 5) % 3]
    odd = [(None, "c0", 1, "G", "c0_g0", 9, 0, 0, 0), ("s1", None, 1, "G", None, 9, 0, 0, 0), ("s2", None, 1, "G", None, 9, 0, 0, 0), ("s1", "c0", 1, None, None, 9, 0, 0, 0), ("s2", "c0", 1, None, None, 9, 0, 0, 0)]
    found = compare.alleles(spark.createDataFrame(rows + odd, POSITION))
    plain = sorted(map(tuple, compare.joined_pairs(spark.createDataFrame(rows, POSITION)).select("genome", "sample_1", "sample_2", "total_positions", "share_allele_pos").collect()))
    assert sorted(map(tuple, compare.packed(found, samples_per_block=4, kernel=kernel).collect())) == plain
    want = [r for r in plain if r[3] > 10]
    assert 0 < len(want) < len(plain)
    assert sorted(map(tuple, compare.packed(found, samples_per_block=4, kernel=kernel, above=10).collect())) == want
    assert compare.packed(found.filter("genome = 'none'"), kernel=kernel).count() == 0


def test_positions_by_number_equal_their_sql(spark):
    """Null, negative and repeated keys, and flags of no channel."""
    rows = [(p, s, q, f, t) for p, s in ((0, 0), (7, 1), (-13, 2), (-8, 2), (None, 3), (4, None), (7, 1), (12345, 9)) for q, f, t in ((3.0, "A", "F"), (4.0, "N", "O"), (5.0, "N", "F"), (None, "R", "F"), (6.0, None, "O"), (7.0, "N", None))]
    lines = spark.createDataFrame(rows, "l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, l_linestatus string")
    want = spark.sql(adapters.VIEWS["profile_positions"], lineitem=lines)
    got = adapters.made_positions(lines)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_pairs_among_members_move_no_pair(spark, monkeypatch):
    monkeypatch.setattr(views, "BLOCK", 3)
    monkeypatch.setattr(views, "FORMED", 5)
    members = [("G", f"s{i}") for i in range(10)] * 2 + [("H", "a"), ("H", "b"), ("I", "z"), (None, "a"), ("H", None)]
    got = views.pairs_among(spark.createDataFrame(members, "genome string, sample_id string"))
    assert sorted(map(tuple, got.collect())) == [("G", f"s{i}", f"s{j}") for i in range(10) for j in range(i + 1, 10)] + [("H", "a", "b")]
    assert got.rdd.getNumPartitions() == 46 // 5 + 1
    assert views.pairs_among(spark.createDataFrame([], "genome string, sample_id string")).count() == 0
    assert "sample_1" not in got._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[-1]


def test_packed_values_come_back():
    columns = [np.array([5, -3, 2**40]), np.array([], np.int64), np.array([-(2**63), 2**63 - 1]), np.array([0.5, np.inf]), pa.array(["", "é", "a b"]), pa.array([], pa.string()), np.arange(1000)]
    for few in (columns[:2], columns):
        got = packing.unpack(packing.pack(few))
        assert [x.to_pylist() if isinstance(x, pa.Array) else x.tolist() for x in got] == [x.to_pylist() if isinstance(x, pa.Array) else x.tolist() for x in few]
    names, at = packing.merged([pa.array(["b", "é"]), pa.array(["a", "b"])])
    assert names.to_pylist() == ["a", "b", "é"] and [x.tolist() for x in at] == [[1, 2], [0, 1]]


@pytest.mark.parametrize("method", ["popani", "cosani_0.9"])
def test_strips_in_several_passes_and_buckets(spark, method, monkeypatch):
    """Rows and lists are packed in many values, a strip is summed in several passes, and samples that no counted position holds are compared too."""
    for name, n in (("STRIP", 4000), ("PASS", 300), ("STEP", 100), ("LISTED", 150), ("BUCKET", 100), ("GIVEN", 40), ("COUNTED", 4), ("NEAR", 2)):
        monkeypatch.setattr(compare, name, n)
    rng = np.random.default_rng(8)
    rows = [(f"s{i}", f"c{p % 3}", int(p // 3), "G", f"g{p // 9}", *map(int, rng.integers(0, 6, 4))) for i in range(30) for p in range(60) if rng.random() < 0.4]
    rows += [(f"t{i}", "c0", p, g, "g0", 9, 9, 0, 0) for i in range(2) for p, g in ((0, "G"), (900, "G"), (7, "H"))]
    df = spark.createDataFrame(rows, POSITION)
    found = compare.alleles(df, method)
    plain = sorted(map(tuple, compare.joined_pairs(df, method).collect()))
    assert sorted(map(tuple, compare.packed(found, method, kernel="strips").collect())) == [r[:5] for r in plain]
    plan, marked = compare._plan(found, "chrom", 256, None, "strips")
    each = [len(list(compare._Listed(iter([pa.record_batch([pa.array([bytes(r.packed) for r in part], pa.binary())], ["packed"])]), 4 if method != "popani" else 1, False).passes(method))) for part in _by_strip(compare._strips(marked, plan.collect(), "chrom", False))]
    assert max(each) > 2
    if method == "popani":
        assert sorted(map(tuple, compare.longest_runs(df, kernel="strips").collect())) == sorted(map(tuple, compare.longest_runs(df, kernel="tiles").collect()))


def _by_strip(lists):
    rows = sorted(lists.collect(), key=lambda r: (r.genome, r.strip))
    return [list(part) for _, part in itertools.groupby(rows, key=lambda r: (r.genome, r.strip))]


def test_lists_of_strips_take_few_bytes(spark):
    """A sample of a list took 13 bytes of shuffle at 60 times sf0.1, as rows of names; it takes some 3 packed."""
    rng = np.random.default_rng(3)
    rows = [(f"SRR{i}", "c0", p, "G", "g", *map(int, rng.integers(0, 9, 4))) for p in range(800) for i in rng.choice(400, 25, replace=False).tolist()]
    plan, marked = compare._plan(compare.alleles(spark.createDataFrame(rows, POSITION)), "chrom", 256, None, "strips")
    lists = compare._strips(marked, plan.collect(), "chrom", False).collect()
    samples = sum(len(packing.unpack(bytes(r.packed))[3]) for r in lists)
    assert samples >= 19_000 and sum(len(r.packed) for r in lists) < 5 * samples


def test_derived_positions_are_written_in_order(spark, tmp_path):
    """Names of a place repeat in a file, so that a position takes few bytes; out of order it took 15."""
    made = adapters._positions(spark, f"{DATA}/sf0.01")
    held = sum(os.path.getsize(p.removeprefix("file:").replace("///", "/")) for p in made.inputFiles())
    lines = spark.read.parquet(f"{DATA}/sf0.01/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().count()
    assert made.count() == lines and held < 6 * lines


def test_stored_counts_meet_a_small_axis_without_a_shuffle(spark, monkeypatch):
    """The axis is read back with a known size; before, all positions were dealt by scaffold to meet it."""
    from strandloom.plans import files

    met, counts = [], matrix.counts
    monkeypatch.setattr(matrix, "counts", lambda *a: met.append(counts(*a)) or met[-1])
    files.QUERIES["stored_counts_conani"](spark, f"{DATA}/sf0.001")
    assert "BroadcastHashJoin" in (plan := met[0]._jdf.queryExecution().sparkPlan().toString()) and "Window" not in plan


def test_long_lists_go_to_few_strips(spark, monkeypatch):
    """A list that all strips need is sent to COPIES of them at most while one task can hold the genome; larger genomes are cut by their joint positions."""
    monkeypatch.setattr(compare, "STRIP", 200)
    monkeypatch.setattr(compare, "PASS", 50)
    monkeypatch.setattr(compare, "COUNTED", 1)
    rows = spark.createDataFrame([("G", "c", p, f"s{i:02d}", 1 + (p + i) % 3) for p in range(20) for i in range(60) if (p * i) % 7], "genome string, chrom string, pos bigint, sample_id string, allele int")
    cut = lambda: len(compare._plan(rows, "chrom", 256, None, "strips")[0].collect()[0].firsts)
    assert cut() == 16
    got = compare.packed(rows, kernel="strips")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, compare.packed(rows, kernel="tiles").select(got.columns).collect()))
    assert compare.shared_runs(rows, kernel="strips").exceptAll(compare.shared_runs(rows, kernel="tiles")).count() == 0
    monkeypatch.setattr(compare, "HELD", 100)
    assert cut() > 32
