import pytest

from loomspan.sources import formats, sinks


def put(path, text):
    path.write_text(text)
    return str(path)


def test_fasta_round_trip(spark, tmp_path):
    src = put(tmp_path / "a.fa", ">one first>x\nACGT\nAC\n>two\n\n>three\nGG\n")
    got = {r["name"]: (r["header"], r["seq"]) for r in formats.read_fasta(spark, src).collect()}
    assert got == {"one": ("one first>x", "ACGTAC"), "two": ("two", ""), "three": ("three", "GG")}
    sinks.write_fasta(formats.read_fasta(spark, src), str(tmp_path / "out"), width=3)
    again = {r["name"]: (r["header"], r["seq"]) for r in formats.read_fasta(spark, str(tmp_path / "out")).collect()}
    assert again == got


def test_paf_bed(spark, tmp_path):
    paf = put(tmp_path / "a.paf", "q\t10\t0\t5\t+\tt\t20\t3\t8\t4\t5\t60\ttp:A:P\tcg:Z:5M\nq\t10\t0\t5\t+\t*\t*\t*\t*\t0\t0\t255\n")
    rows = formats.read_paf(spark, paf).collect()
    assert rows[0]["tags"] == {"tp": "P", "cg": "5M"} and rows[0]["tend"] == 8 and rows[1]["target"] is None
    bed = put(tmp_path / "a.bed", "#c\ntrack x\nchr1\t0\t5\tn\nchr1\t7\t9\nshort\t1\n")
    assert [tuple(r) for r in formats.read_bed(spark, bed).collect()] == [("chr1", 0, 5, "n"), ("chr1", 7, 9, None)]
    with pytest.raises(Exception, match="not an integer"):
        formats.read_bed(spark, put(tmp_path / "b.bed", "chr1\tx\t5\n")).collect()


def test_wig_vcf_gfa(spark, tmp_path):
    wig = put(tmp_path / "a.wig", "fixedStep chrom=c1 start=5 step=2\n0.5\n1\nfixedStep chrom=c2 start=1\n-2\n")
    assert sorted(tuple(r) for r in formats.read_wig(spark, wig).collect()) == [("c1", 4, 0.5), ("c1", 6, 1.0), ("c2", 0, -2.0)]
    vcf = put(tmp_path / "a.vcf", "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nc1\t5\t.\tA\tC,G\t.\tPASS\tLV=0;AT=x\tDP:GT\t3:0|1\t1:.\n")
    row = formats.read_vcf(spark, vcf).first()
    assert (row["pos"], row["alts"], row["info"], row["genotypes"]) == (4, ["C", "G"], {"LV": "0", "AT": "x"}, {"s1": "0|1", "s2": "."})
    sinks.write_vcf(formats.read_vcf(spark, vcf), str(tmp_path / "v"), ["s1", "s2"])
    assert spark.read.text(str(tmp_path / "v")).first()[0] == "c1\t5\t.\tA\tC,G\t.\tPASS\tAT=x;LV=0\tGT\t0|1\t."
    gfa = put(tmp_path / "a.gfa", "H\tVN:Z:1.1\nS\t1\tAC\nS\t2\tG\nL\t1\t+\t2\t-\t0M\nW\ts\t1\tc\t0\t3\t>1<2\n")
    nodes, edges, walks = formats.read_gfa(spark, gfa)
    assert nodes.count() == 2 and tuple(edges.first()) == ("1", "+", "2", "-") and walks.first()["steps"] == [">1", "<2"]


def test_manifest_and_tables(spark, tmp_path):
    newick, rows = formats.read_seqfile(spark, put(tmp_path / "s.txt", "(a:1,b:2)r;\n*a /x/a.fa\nb /x/b.fa\n"))
    assert newick == "(a:1,b:2)r;" and sorted(tuple(r) for r in rows.collect()) == [("a", "/x/a.fa", True), ("b", "/x/b.fa", False)]
    with pytest.raises(ValueError, match="twice"):
        formats.read_seqfile(spark, put(tmp_path / "t.txt", "a /x\na /y\n"))
    with pytest.raises(ValueError, match="header"):
        formats.read_table(spark, put(tmp_path / "t.tsv", "#a\tc\n1\t2\n"), "a int, b int", header=["a", "b"])
    assert formats.read_table(spark, put(tmp_path / "u.tsv", "#a\tb\n1\t2\n"), "a int, b int", header=["a", "b"]).collect()[0]["b"] == 2
