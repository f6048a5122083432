"""Sources that are read by ranges: BAM against the reader of SAM text, FASTA by splits."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import alignment
from tidemark.operators import annotation
from tidemark.sources import bam, formats

CONTIGS = [("chr1", 100_000), ("chr2", 50_000), ("chrUn_x", 900)]


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(6)
    out = []
    for i in range(900):
        n = rng.choice([0, 1, 7, 50, 51, 150]) if i % 50 else 30_000  # some records are longer than a block
        seq = "".join(rng.choice("ACGTN") for _ in range(n))
        qual = "".join(chr(33 + rng.randint(0, 60)) for _ in range(n))
        cigar = "*" if not n or i % 11 == 0 else f"{n}M" if n < 40 else f"3S{n - 20}M2D5N{10}M{2}I5H5="
        chrom, pos = (rng.choice(CONTIGS)[0], rng.randint(1, 800)) if i % 13 else ("*", 0)
        mate = rng.choice(["*", "=", "chr2"])
        tags = [f"NM:Z:{i % 5}", "XT:Z:a b:c"] if i % 3 else []
        out.append("\t".join([f"read{i}", str(rng.choice([0, 16, 99, 147, 4])), chrom, str(pos), str(rng.randint(0, 60)), cigar, mate if chrom != "*" or mate != "=" else "*", str(rng.randint(0, 500)), str(rng.randint(-300, 300)), seq or "*", qual or "*", *tags]))
    return out


def rows_of(df):
    return sorted(map(str, df.withColumn("tags", F.array_sort(F.map_entries("tags"))).collect()))


@pytest.fixture(scope="module")
def both(spark, lines, tmp_path_factory):
    where = tmp_path_factory.mktemp("bam")
    (where / "a.sam").write_text("@HD\tVN:1.6\n" + "\n".join(lines) + "\n")
    sam = formats.read_sam(spark, str(where / "a.sam"))
    number = {c: i for i, (c, _) in enumerate(CONTIGS)}
    rows = sorted((r.asDict() for r in sam.withColumn("tags", F.map_entries("tags")).collect()), key=lambda r: int(r["name"][4:]))
    data = bam.header(CONTIGS) + b"".join(bam.encode({**r, "tags": [tuple(t) for t in r["tags"]]}, number) for r in rows)
    rng, at, out = random.Random(1), 0, []
    while at < len(data):  # blocks of any size, empty ones too
        n = rng.choice([0, 100, 3000, 65_000])
        out.append(bam.deflate(data[at : at + n]) or bam.END)
        at += n
    (where / "a.bam").write_bytes(b"".join(out) + bam.END)
    return sam, str(where / "a.bam")


@pytest.mark.parametrize("split", [1, 2])
def test_ranges(spark, both, split):
    """Ranges from a few bytes to the whole file give each record once."""
    sam, path = both
    want = rows_of(sam)
    for size in (997, 20_000) if split == 1 else (70_000, 1 << 30):
        got = bam.read_bam(spark, path, size)
        assert rows_of(got) == want
        assert got.columns == sam.columns


def test_no_task_reads_the_file(spark, both):
    """A range reads its own blocks and what its last record needs."""
    _, path = both
    reader = bam.BamReader(path, 30_000)
    parts = reader.partitions()
    assert len(parts) > 5 and sum(p.end - p.start for p in parts) == parts[0].size
    counts = [sum(b.num_rows for b in reader.read(p)) for p in parts]
    assert sum(counts) == 900 and max(counts) < 450


def test_tags():
    data = b"".join([b"NMC\x05", b"ASs" + struct.pack("<h", -300), b"XFf" + struct.pack("<f", 2.5), b"XAAq", b"XZZhi there\0", b"XBBs" + struct.pack("<Ihh", 2, -1, 7), b"XIi" + struct.pack("<i", -70000)])
    name = b"r\0"
    record = bam._FIXED.pack(0, 10, len(name), 3, 0, 1, 16, 3, -1, -1, 0) + name + struct.pack("<I", 3 << 4) + bytes([0x12, 0x40]) + b"\xff\xff\xff" + data
    row = bam.decode(record, ["c"])
    assert row[:13] == ("r", 16, "c", 10, 13, "-", 3, "3M", None, -1, 0, "ACG", "*")
    assert row[13] == [("NM", "5"), ("AS", "-300"), ("XF", "2.5"), ("XA", "q"), ("XZ", "hi there"), ("XB", "s,-1,7"), ("XI", "-70000")]


def test_long_cigars():
    """More operations than a record has room for go through a tag."""
    cigar = "1M1I" * 40_000
    row = {"name": "x", "flag": 0, "chrom": "c", "start": 5, "end": 40_005, "mapq": 1, "cigar": cigar, "mate_chrom": None, "mate_start": -1, "tlen": 0, "seq": "A" * 80_000, "qual": "*", "tags": []}
    got = bam.decode(bam.encode(row, {"c": 0})[4:], ["c"])
    assert got[7] == cigar and got[4] == 40_005 and got[13] == []


def test_write(spark, both, tmp_path):
    sam, _ = both
    bam.write_bam(sam.repartition(3), CONTIGS, str(tmp_path / "out"))
    files = list((tmp_path / "out").iterdir())
    assert len(files) == 3 and all(f.suffix == ".bam" and f.read_bytes().endswith(bam.END) for f in files)
    assert rows_of(bam.read_bam(spark, str(tmp_path / "out"), 5000)) == rows_of(sam)
    with pytest.raises(Exception, match="not a BAM file"):
        (tmp_path / "bad.bam").write_bytes(bam.deflate(b"no such thing at all"))
        bam.read_bam(spark, str(tmp_path / "bad.bam")).count()


def test_far_places_are_no_false_starts(tmp_path):
    """One byte before a record on the first contig at 2^24 and beyond, its bytes read as another record with an empty name."""
    rng = random.Random(2)
    data = [bam.header([("chr0", 1 << 26)])]
    for i in range(3000):
        start = (1 << 24) + rng.randrange(1 << 20)
        data.append(bam.encode({"name": "r" * rng.randint(30, 50), "flag": 99, "chrom": "chr0", "start": start, "end": start + 9, "mapq": 30, "cigar": "9M", "mate_chrom": "chr0", "mate_start": start + 20, "tlen": 0, "seq": "*", "qual": "*", "tags": [("RX", "AC")]}, {"chr0": 0}))
    begins = set(np.cumsum([len(x) for x in data])[:-1].tolist())
    data, blocks, places, at = b"".join(data), [], [], 0
    while at < len(data):
        places.append((sum(map(len, blocks)), at))
        blocks.append(bam.deflate(data[at : at + 700]))
        at += 700
    (tmp_path / "far.bam").write_bytes(b"".join(blocks) + bam.END)
    size = (tmp_path / "far.bam").stat().st_size
    with open(tmp_path / "far.bam", "rb") as file:
        for place, at in places[1:-1]:
            assert at + bam.first_record(bam.Stream(file, size, place), 1, size) in begins
    reader = bam.BamReader(str(tmp_path / "far.bam"), 2000)
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 3000


def test_batches_as_records_one_by_one(monkeypatch):
    """Batches are encoded and decoded to the bytes and rows that each record gives by itself."""
    rng = random.Random(8)
    rows = []
    for i in range(500):
        n = rng.choice([0, 1, 2, 7, 50, 151])
        seq, qual = "".join(rng.choice("ACGTNacgRx=") for _ in range(n)), "".join(chr(34 + rng.randint(0, 59)) for _ in range(n))
        chrom, start = rng.choice(["chr1", "chr2", "other", None]), rng.choice([-1, 0, 5, 16_380, 131_070, 70_000_000, (1 << 29) - 3])
        tags = [(rng.choice(["NM", "XT", "RX"]), rng.choice(["", "AC", "a b:c", "é"])) for _ in range(rng.randint(0, 3))]
        rows.append({"name": f"read{i}", "flag": rng.choice([0, 16, 99, 2047]), "chrom": chrom, "start": start, "end": start + rng.choice([0, 1, 90, 20_000]), "strand": "+", "mapq": rng.randint(0, 60), "cigar": rng.choice([None, "*", f"{n}M", "3S5M2D1=", "1M" * 300]), "mate_chrom": rng.choice([None, "chr2"]), "mate_start": rng.choice([-1, 77]), "tlen": rng.randint(-300, 300), "seq": rng.choice([seq or "*"]) if n else rng.choice([None, "*"]), "qual": rng.choice([qual, None, "*"]) if n > 1 else None, "tags": tags})
    number = {"chr1": 0, "chr2": 1}
    whole = pa.RecordBatch.from_pylist([{**r, "tags": list({**dict(r["tags"])}.items())} for r in rows], bam._ARROW)
    records = [bam.encode(r, number) for r in whole.to_pylist()]
    decoded = bam._batch([bam.decode(r[4:], ["chr1", "chr2"]) for r in records])
    at = np.cumsum([0, *map(len, records)])
    for name in ("encode", "decode"):
        monkeypatch.setattr(bam, name, None)
    for low, high in ((0, 500), (123, 321), (7, 8), (9, 9)):
        got = bam.encode_all(whole.slice(low, high - low), number) if high > low else b""
        assert got == b"".join(records[low:high])
    data = b"".join(records)
    assert bam.decode_all(data, at[:-1] + 4, np.diff(at) - 4, ["chr1", "chr2"]).to_pylist() == decoded.to_pylist()
    with pytest.raises(TypeError):  # what is no plain record goes by itself
        bam.encode_all(whole.slice(0, 1).set_column(1, "flag", pa.array([70_000], pa.int32())), number)


def test_bins():
    assert [bam._bin(a, b) for a, b in ((0, 1), (0, 1 << 14), (16_000, 17_000), (0, 1 << 29), (1 << 28, (1 << 28) + 5))] == [4681, 4681, 585, 0, 4681 + (1 << 14)]
    assert np.array_equal(bam._PAIRS[0x12], np.frombuffer(b"AC", np.uint8))


@pytest.mark.parametrize("split", ["61", "1000", "134217728"])
def test_contigs_by_splits(spark, tmp_path, split):
    """A chromosome over many splits: pieces know their header and place; empty records, blank lines, lower case, a file without a last line end."""
    rng = random.Random(3)
    want = {}
    for f in range(2):
        out = ["\n", ">empty%d\n" % f]
        want["empty%d" % f] = ""
        for k, n in enumerate([0, 5, 3000, 60, 700]):
            seq = "".join(rng.choice("ACGTNacgt") for _ in range(n))
            want[f"chr{f}_{k} some text"] = seq
            out += [f">chr{f}_{k} some text\n"] + [seq[i : i + 60] + rng.choice(["\n", "\r\n", "\n\n"]) for i in range(0, n, 60)]
        (tmp_path / f"{f}.fa").write_text("".join(out).rstrip("\n"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = formats.read_contigs(spark, str(tmp_path), most=100)
        rows = got.collect()
        found = {}
        for r in sorted(rows, key=lambda r: (r.header, r.start, r.end)):
            assert r.end == r.start + len(r.seq) and r.start == len(found.get(r.header, ""))
            found[r.header] = found.get(r.header, "") + r.seq
        assert found == want
        assert max(len(r.seq) for r in rows) <= 160
        assert {r.chrom: r.length for r in formats.contig_lengths(got).collect()} == {h.split(" ")[0]: len(s) for h, s in want.items()}
        gc = {r.header: (r.bases, r.gc) for r in formats.contig_gc(got).collect()}
        assert gc == {h: (len(s), round(sum(c in "GCgc" for c in s) / len(s), 6) if s else None) for h, s in want.items()}
        lines = spark.read.text(str(tmp_path)).select("_metadata.file_block_start", "_metadata.file_path").distinct().count()
        assert lines > 50 if split == "61" else lines == 2 if split == "134217728" else lines > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_region_reads_open_few_files(spark, tmp_path):
    """A region opens the files of bins that reach it, long reads from bins before it included."""
    rng = random.Random(8)
    rows = [(i, rng.choice("ab"), s, s + rng.choice([1, 50, 3000])) for i, s in enumerate(rng.randint(0, 100_000) for _ in range(600))] + [(900, None, 5, 9), (901, "a", 0, 99_000)]
    table = spark.createDataFrame(rows, "id long, chrom string, start long, end long")
    formats.write_tags(table, str(tmp_path / "tags"), 1000)
    for start, end in ((40_000, 40_500), (0, 10), (99_990, 200_000), (150_000, 160_000)):
        got = formats.read_region(spark, str(tmp_path / "tags"), "a", start, end)
        assert sorted(r.id for r in got.collect()) == sorted(i for i, c, s, e in rows if c == "a" and s < end and e > start)
        opened = got.select(F.input_file_name()).distinct().count()
        assert opened <= 8
    every = spark.read.parquet(str(tmp_path / "tags" / "tags")).select(F.input_file_name()).distinct().count()
    assert every > 150


def test_readers_and_writers(spark, tmp_path):
    """What is written comes back; lines that are no rows are left out; coordinates as each format has them."""
    write = lambda name, text: ((tmp_path / name).write_text(text), str(tmp_path / name))[1]
    gtf = write("a.gtf", '#!genome\nc\tsrc\texon\t11\t20\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\nc\tsrc\texon\t31\t40\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\n')
    rows = formats.read_gtf(spark, gtf)
    assert [(r.start, r.end) for r in rows.orderBy("start").collect()] == [(11, 20), (31, 40)]
    assert [tuple(r) for r in annotation.transcript_table(rows).collect()] == [("g1", "t1", "c", "+", 10, 40, 2)]
    saf = write("a.saf", "GeneID\tChr\tStart\tEnd\tStrand\ng\tc\t1\t9\t+\n")
    assert [tuple(r) for r in formats.read_saf(spark, saf).collect()] == [("g", "c", 1, 9, "+")]
    sheet = write("s.csv", "sample,fastq_1,fastq_2\nA,a_1.fq.gz,a_2.fq.gz\nB,b.fq.gz,\n")
    assert [tuple(r) for r in formats.read_samplesheet(spark, sheet).collect()] == [("A", "a_1.fq.gz", "a_2.fq.gz"), ("B", "b.fq.gz", None)]
    tuning = write("t.csv", "LtProbB,UTS,merged,dissociated,total,errorRate,txSize\n-100,5,10,0,10,0.0061,921\n-150,5,9,0,9,0.0061,900\n")
    best = annotation.first_wins(formats.read_tuning(spark, tuning).withColumn("row_no", F.monotonically_increasing_id()), "errorRate", "row_no").first()
    assert (best.LtProbB, best.UTS, best.total) == (-100, 5, 10)
    bed = write("a.bed", "track name=x\n#c\nc\t5\t9\tn\t1.5\t-\n")
    assert [tuple(r) for r in formats.read_bed(spark, bed, 6).collect()] == [("c", 5, 9, "n", 1.5, "-")]
    depth = spark.createDataFrame([("c", 0, 5, 2), ("c", 5, 9, 1)], "chrom string, start long, end long, depth long")
    formats.write_bedgraph(depth, str(tmp_path / "d"))
    assert sorted(map(tuple, formats.read_bedgraph(spark, str(tmp_path / "d")).collect())) == [("c", 0, 5, 2.0), ("c", 5, 9, 1.0)]
    formats.write_by_key(spark.createDataFrame([("g1", 1, 2.5), ("g1", 2, 0.5), ("g2", 3, 1.0)], "group string, n int, x double"), "group", str(tmp_path / "k"))
    for group, n in (("g1", 2), ("g2", 1)):
        back = spark.read.csv(str(tmp_path / "k" / f"group={group}"), header=True)
        assert back.columns == ["n", "x"] and back.count() == n
    assert [r.chrom for r in spark.createDataFrame([("chr1",), ("X",), ("chrUn_1",), ("MT",), ("random",)], "chrom string").where(alignment.is_standard(F.col("chrom"))).collect()] == ["chr1", "X", "MT"]


def test_ancestors_over_several_levels(spark):
    lines = [("gene", "ID=g1"), ("pseudo", "ID=p1;Parent=g1"), ("mRNA", "ID=t1;Parent=p1"), ("exon", "ID=e1;Parent=t1,t2"), ("mRNA", "ID=t2;Parent=g1"), ("CDS", "Parent=t2"), ("exon", "Parent=lone")]
    gff = spark.createDataFrame([("c", "s", f, 1, 9, ".", "+", ".", a) for f, a in lines], formats.GTF)
    got = sorted((r.feature, r.attributes) for r in annotation.gff_to_gtf(gff).collect())
    name = lambda t, g: f'transcript_id "{t}"; gene_id "{g}";'
    assert got == sorted([("exon", name("t1", "g1")), ("exon", name("t2", "g1")), ("CDS", name("t2", "g1")), ("exon", name("lone", "lone"))])
    deep = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(50)], "id string, parent string")
    assert {r.root for r in annotation.ancestors(deep).collect()} == {"n50"}
    with pytest.raises(ValueError, match="cycle"):
        annotation.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parent string"), most=4)
