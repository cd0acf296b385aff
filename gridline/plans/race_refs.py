"""Reference (lookup) tables of the race domain (D-5..D-8).

The rows are fixed values of the domain -- nationality regions, team colours and
asset names, country codes and flag asset names, three-letter driver codes -- kept
here as plain text in their natural order. Asset URLs are built from configurable
base locations (the files themselves are not part of this library). These tables are
small and fixed; they are written once by ``write_references`` and joined as lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writes import overwrite

# ---------------------------------------------------------------------------------
# FIXED VALUES: nationality -> region
# ---------------------------------------------------------------------------------
NATIONALITY_REGION = [
    ("British", "Europe"), ("Italian", "Europe"), ("French", "Europe"), ("German", "Europe"),
    ("Swiss", "Europe"), ("Dutch", "Europe"), ("Belgium", "Europe"), ("Belgian", "Europe"),
    ("Irish", "Europe"), ("Spanish", "Europe"), ("Austrian", "Europe"), ("East German", "Europe"),
    ("Russian", "Europe"), ("Finnish", "Europe"), ("Polish", "Europe"), ("Portuguese", "Europe"),
    ("Hungarian", "Europe"), ("Danish", "Europe"), ("Czech", "Europe"), ("Liechtensteiner", "Europe"),
    ("Monegasque", "Europe"), ("Swedish", "Europe"), ("Argentine-italian", "Europe"),
    ("American-italian", "Europe"),
    ("American", "North America"), ("Canadian", "North America"), ("Mexican", "North America"),
    ("Brazilian", "South America"), ("Chilean", "South America"), ("Argentine", "South America"),
    ("Uruguayan", "South America"), ("Venezuelan", "South America"), ("Colombian", "South America"),
    ("South African", "Africa"), ("Rhodesian", "Africa"),
    ("Indian", "Asia"), ("Chinese", "Asia"), ("Japanese", "Asia"), ("Malaysian", "Asia"), ("Hong Kong", "Asia"),
    ("Indonesian", "Asia"), ("Thai", "Asia"),
    ("Australian", "Oceania"), ("New Zealand", "Oceania"), ("New Zealander", "Oceania"),
]

# ---------------------------------------------------------------------------------
# FIXED VALUES: constructor id, colour code, asset name
# ---------------------------------------------------------------------------------
CONSTRUCTOR_COLORS = [
    ("alfa", "#900000", "alfa-romeo"), ("alphatauri", "#2B4562", "alphatauri"), ("alpine", "#0090FF", "alpine"),
    ("aston_martin", "#006F62", "aston-martin"), ("caterham", "#005030", "caterham"),
    ("ferrari", "#DC0000", "ferrari"), ("force_india", "#FF80C0", "force-india"), ("haas", "#B6BABD", "haas"),
    ("hrt", "#B22222", "hrt"), ("lotus_f1", "#CBA135", "lotus"), ("lotus_racing", "#004225", "lotus-racing"),
    ("manor", "#D71920", "manor"), ("marussia", "#6E0000", "marussia"), ("mclaren", "#FF8700", "mclaren"),
    ("mercedes", "#00D2BE", "mercedes"), ("racing_point", "#F596C8", "racing-point"),
    ("rb", "#6692FF", "racing-bulls"), ("red_bull", "#304FFE", "red-bull"), ("renault", "#FFF500", "renault"),
    ("sauber", "#00C853", "sauber"), ("toro_rosso", "#0032A0", "toro-rosso"), ("virgin", "#C8102E", "virgin"),
    ("williams", "#005AFF", "williams"),
]

# ---------------------------------------------------------------------------------
# FIXED VALUES: country, ISO 3166-1 alpha-3 code, flag asset name
# ---------------------------------------------------------------------------------
COUNTRY_FLAGS = [
    ("Argentina", "ARG", "flag-argentina"), ("Australia", "AUS", "flag-australia"),
    ("Austria", "AUT", "flag-austria"), ("Azerbaijan", "AZE", "flag-azerbaijan"),
    ("Bahrain", "BHR", "flag-bahrain"), ("Belgium", "BEL", "flag-belgium"), ("Brazil", "BRA", "flag-brazil"),
    ("Canada", "CAN", "flag-canada"), ("China", "CHN", "flag-china"), ("France", "FRA", "flag-france"),
    ("Germany", "DEU", "flag-germany"), ("Hungary", "HUN", "flag-hungary"), ("India", "IND", "flag-india"),
    ("Italy", "ITA", "flag-italy"), ("Japan", "JPN", "flag-japan"), ("Malaysia", "MYS", "flag-malaysia"),
    ("Mexico", "MEX", "flag-mexico"), ("Monaco", "MCO", "flag-monaco"), ("Morocco", "MAR", "flag-morocco"),
    ("Netherlands", "NLD", "flag-netherlands"), ("Portugal", "PRT", "flag-portugal"),
    ("Qatar", "QAT", "flag-qatar"), ("Russia", "RUS", "flag-russia"),
    ("Saudi Arabia", "SAU", "flag-saudi-arabia"), ("Singapore", "SGP", "flag-singapore"),
    ("South Africa", "ZAF", "flag-south-africa"), ("Korea", "KOR", "flag-south-korea"),
    ("Spain", "ESP", "flag-spain"), ("Sweden", "SWE", "flag-sweden"), ("Switzerland", "CHE", "flag-switzerland"),
    ("Turkey", "TUR", "flag-trkiye"), ("UAE", "ARE", "flag-united-arab-emirates"),
    ("UK", "GBR", "flag-united-kingdom"), ("USA", "USA", "flag-united-states"),
]

# ---------------------------------------------------------------------------------
# FIXED VALUES: driver id -> three-letter driver code
# ---------------------------------------------------------------------------------
DRIVER_CODES = [
    ("hamilton", "HAM"), ("max_verstappen", "VER"), ("leclerc", "LEC"), ("russell", "RUS"), ("sainz", "SAI"),
    ("norris", "NOR"), ("piastri", "PIA"), ("alonso", "ALO"), ("stroll", "STR"), ("gasly", "GAS"),
    ("ocon", "OCO"), ("tsunoda", "TSU"), ("hulkenberg", "HUL"), ("bottas", "BOT"), ("zhou", "ZHO"),
    ("albon", "ALB"), ("sargeant", "SAR"), ("ricciardo", "RIC"), ("bearman", "BEA"), ("antonelli", "ANT"),
    ("colapinto", "COL"), ("lawson", "LAW"), ("hadjar", "HAD"), ("bortoleto", "BOR"), ("doohan", "DOO"),
    ("kvyat", "KVY"), ("kubica", "KUB"), ("giovinazzi", "GIO"), ("latifi", "LAT"), ("mazepin", "MAZ"),
    ("de_vries", "DEV"), ("mick_schumacher", "MSC"), ("kevin_magnussen", "MAG"), ("perez", "PER"),
    ("gutierrez", "GUT"), ("wehrlein", "WEH"), ("vandoorne", "VAN"), ("massa", "MAS"), ("vettel", "VET"),
    ("webber", "WEB"), ("button", "BUT"), ("rosberg", "ROS"), ("raikkonen", "RAI"), ("grosjean", "GRO"),
    ("kobayashi", "KOB"), ("sutil", "SUT"), ("buemi", "BUE"), ("vergne", "VGN"), ("nasr", "NAS"),
    ("maldonado", "MAL"), ("heidfeld", "HEI"), ("wurz", "WUR"), ("gene", "GEN"), ("panis", "PAN"),
    ("liuzzi", "LIU"), ("klien", "KLI"), ("badoer", "BAD"), ("fisichella", "FIS"), ("piquet_jr", "PIQ"),
    ("karthikeyan", "KAR"), ("chandhok", "CHA"), ("brendon_hartley", "HAR"), ("sirotkin", "SIR"),
    ("ericsson", "ERI"), ("palmer", "PAL"), ("haryanto", "NTO"), ("merhi", "MER"), ("rossi", "OSI"),
    ("stevens", "STE"), ("pic", "PIC"), ("chilton", "CHI"), ("bianchi", "BIA"), ("van_der_garde", "VDG"),
    ("senna", "SEN"), ("petrov", "PET"), ("dambrosio", "DAM"), ("trulli", "TRU"), ("glock", "GLO"),
    ("kovalainen", "KOV"), ("di_grassi", "DIG"), ("yamamoto", "YAM"), ("aitken", "AIT"),
    ("pietro_fittipaldi", "FIT"), ("arvid_lindblad", "LIN"),
]

LOGO_VARIANTS = [(size, tone) for size in (16, 32, 64) for tone in ("white", "dark", "transparent")]


def nationality_region(spark: SparkSession) -> DataFrame:
    """D-5."""
    return spark.createDataFrame(NATIONALITY_REGION, "nationality STRING, region STRING")


def constructor_color_code(spark: SparkSession, png_base: str = "assets/constructors-png",
                           svg_base: str = "assets/constructors-svg") -> DataFrame:
    """D-6: colour plus nine sized logos, a circular logo and an SVG, built from the asset name."""
    base = spark.createDataFrame(CONSTRUCTOR_COLORS, "constructor_id STRING, color_code STRING, asset STRING")
    logos = {f"logo_{s}_{t}_png": F.concat(F.lit(f"{png_base}/{s}/{t}/"), F.col("asset"), F.lit(".png"))
             for s, t in LOGO_VARIANTS}
    return base.select(
        "constructor_id", "color_code", *[c.alias(n) for n, c in logos.items()],
        F.concat(F.lit(f"{png_base}/circular_logos_32/"), F.col("asset"), F.lit(".png")).alias("circular_png"),
        F.concat(F.lit(f"{svg_base}/"), F.col("asset"), F.lit(".svg")).alias("logo_svg"))


def country_image(spark: SparkSession, flag_base: str = "assets/country-flags-png") -> DataFrame:
    """D-7: flags in three sizes per country."""
    base = spark.createDataFrame(COUNTRY_FLAGS, "country STRING, country_code STRING, asset STRING")
    return base.select("country", "country_code", *[
        F.concat(F.lit(f"{flag_base}/"), F.col("asset"), F.lit(f"-{px}px.png")).alias(f"flag_{px}_png")
        for px in (32, 64, 128)])


def driver_code(spark: SparkSession) -> DataFrame:
    """D-8."""
    return spark.createDataFrame(DRIVER_CODES, "driver_id STRING, fia_driver_code STRING")


def write_references(spark: SparkSession, root: str) -> dict[str, str]:
    """K6/K7: (re)write the four lookup tables under ``root``; returns their paths."""
    tables = {"ref_nationality_region": nationality_region(spark),
              "ref_constructor_color_code": constructor_color_code(spark),
              "ref_country_image": country_image(spark), "ref_driver_code": driver_code(spark)}
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{name}"
        overwrite(df.coalesce(1), paths[name])
    return paths
