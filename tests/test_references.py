"""Race-domain lookup tables: sizes, keys and built asset names."""

from gridline.plans import race_refs as R
from gridline.session import scratch_path


def test_reference_tables(spark):
    assert R.nationality_region(spark).count() == 45
    cc = R.constructor_color_code(spark)
    assert cc.count() == 23 and len(cc.columns) == 13
    red = cc.filter("constructor_id = 'red_bull'").collect()[0]
    assert red.color_code == "#304FFE" and red.logo_svg.endswith("/red-bull.svg")
    assert red.logo_32_dark_png.endswith("/32/dark/red-bull.png")
    ci = R.country_image(spark)
    assert ci.count() == 34 and ci.filter("country = 'UK'").collect()[0].flag_64_png.endswith(
        "flag-united-kingdom-64px.png")
    dc = R.driver_code(spark)
    assert dc.count() == 84 and dc.select("driver_id").distinct().count() == 84


def test_write_references(spark):
    paths = R.write_references(spark, scratch_path(spark, "refs"))
    assert spark.read.parquet(paths["ref_driver_code"]).count() == 84
