import pytest
from pyspark.sql import functions as F

from loomspan.functions import bases, names


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_names(spark):
    lit = F.lit
    assert one(spark, names.sanitize(lit("chr1:11-20 text"), lit("hg"))) == "id=hg|chr1_sub_10_20"
    assert one(spark, names.sanitize(lit("a#b#c:x"), cut_hash=True)) == "c_x"
    assert one(spark, names.sanitize(lit("c:0-5"))) == "c_sub_0_5"
    assert one(spark, names.subpath(lit("chr1_sub_10_20_sub_2_5"))) == ("chr1", 12, 3)
    assert one(spark, names.subpath(lit("chr1"))) == ("chr1", 0, None)
    assert one(spark, names.path_name(lit("s#1#c[5-9]"), lit(4))) == ("s#1", "c", 5, 9)
    assert one(spark, names.path_name(lit("plain"), lit(4))) is None
    assert one(spark, names.reverse_path(lit(">1>2<3"))) == ">3<2<1"
    assert one(spark, names.strip_event(lit("id=x|chr1"))) == "chr1"


def test_bases(spark):
    lit = F.lit
    assert one(spark, bases.reverse_complement(lit("ACgt"))) == "acGT"
    assert one(spark, bases.runs(lit("AbcDEf"), "[a-z]")) == [(1, 3), (5, 6)]
    ranges = F.array(F.struct(lit(1).cast("long").alias("start"), lit(3).cast("long").alias("end")))
    assert one(spark, bases.mask_ranges(lit("ACGT"), ranges)) == "AcgT"
    assert one(spark, bases.mask_ranges(lit("ACGT"), ranges, soft=False)) == "ANNT"
    assert one(spark, bases.soften_homopolymers(lit("AAAACG"), 2)) == "AAaaCG"
    assert one(spark, bases.cs_to_cigar(lit(":5*ac+gg-t"))) == "5=1X2I1D"
    assert one(spark, bases.cs_score(lit(":5*ac+gg"), 1, -1, 4, 1)) == 5 - 1 - 5
    assert one(spark, bases.alt_count(lit("0|1"))) == 1 and one(spark, bases.alt_count(lit("."))) == -1
    assert one(spark, bases.zygosity(lit("1/2"))) == "het"
    assert one(spark, bases.variant_type(lit("AC"), lit("GT"))) == "INV"
    with pytest.raises(Exception, match="not a sequence"):
        one(spark, bases.plain_bases(lit("AX")))
    assert bases.parse_size("4Gi") == 4 * 2**30 and bases.parse_size("10k") == 10_000
    assert sum(bases.jukes_cantor(0.3)[0]) == pytest.approx(1)
