"""Column helpers: text to numbers and colours, hashing, identifiers, projections."""
from __future__ import annotations

import math
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from placeloom.functions import catalogs as cat


def lit_map(values: dict) -> Column:
    """A small constant dict as a MAP literal."""
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])


def lookup(values: dict, key: Column) -> Column:
    return F.try_element_at(lit_map(values), key)


def tag(key: str, tags: str | Column = "tags") -> Column:
    return F.try_element_at(F.col(tags) if isinstance(tags, str) else tags, F.lit(key))


def first_of(*values: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def truthy(value: Column) -> Column:
    """A number that is present and not zero, else NULL."""
    return F.nullif(value, F.lit(0.0))


def centi(value: Column) -> Column:
    """Two decimals without the dialect-dependent rounding of doubles."""
    return F.floor(value * 100 + 0.5) / 100


def half_up(value: Column) -> Column:
    return F.floor(value + 0.5).cast("bigint")


# ---------------------------------------------------------------- text to values
def parse_measure(text: Column) -> Column:
    """Metres from tag text: a leading number with comma or dot, feet converted; NULL when there is none."""
    pattern = r"^\s*(-?[0-9]+([.,][0-9]+)?)\s*(ft|')?"
    number = F.translate(F.regexp_extract(text, pattern, 1), ",", ".").try_cast("double")
    return F.when(F.regexp_extract(text, pattern, 3) != "", number * 0.3048).otherwise(number)


def parse_colour(text: Column) -> Column:
    """ARRAY<DOUBLE> of red, green, blue in 0..1 from a colour name or 3/6 hex digits; NULL otherwise."""
    word = F.regexp_replace(F.lower(F.trim(text)), " ", "")
    named = F.try_element_at(
        F.create_map(*[c for k, v in cat.NAMED_COLOURS.items() for c in (F.lit(k), F.array(*map(F.lit, v)))]), word)
    digits = F.regexp_extract(word, r"^#?([0-9a-f]{6}|[0-9a-f]{3})$", 1)
    wide = F.when(F.length(digits) == 3, F.regexp_replace(digits, "(.)", "$1$1")).otherwise(digits)
    channel = [F.conv(F.substring(wide, p, 2), 16, 10).try_cast("double") / 255 for p in (1, 3, 5)]
    return F.coalesce(named, F.when(F.length(wide) == 6, F.array(*channel)))


def nearest_key(rgb: Column, palette: dict) -> Column:
    """Palette key with the least squared distance; the earlier key wins a tie. No join: the palette is a literal."""
    entries = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("k"), *[F.lit(float(c)).alias(a) for c, a in zip(v, "rgb")])
                        for n, (k, v) in enumerate(palette.items())])
    scored = F.transform(entries, lambda e: F.struct(
        ((rgb[0] - e["r"]) ** 2 + (rgb[1] - e["g"]) ** 2 + (rgb[2] - e["b"]) ** 2).alias("d"), e["n"].alias("n"), e["k"].alias("k")))
    return F.when(rgb.isNotNull(), F.array_min(scored)["k"])


# ---------------------------------------------------------------- hashing
def hash_unit(*keys: Column) -> Column:
    """0..1 from the first 32 bits of the SHA-1 of the keys joined with '|'."""
    digest = F.substring(F.sha1(F.concat_ws("|", *[k.cast("string") for k in keys]).cast("binary")), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(4294967295.0)


def pick_unit(key: Column, purpose: str) -> Column:
    """The unit a weighted pick uses: its hashed text is the pair written as ('key', 'purpose')."""
    return hash_unit(F.concat(F.lit("('"), key.cast("string"), F.lit(f"', '{purpose}')")))


def weighted_pick(unit: Column, weights: dict) -> Column:
    """First key whose running weight reaches unit * total, in declared order."""
    total, running, choice = sum(weights.values()), 0.0, None
    for key, weight in weights.items():
        running += weight
        reached = F.lit(running) >= unit * total
        choice = F.when(reached, key) if choice is None else choice.when(reached, key)
    return choice.otherwise(next(iter(weights)))


def pick_by_region(region: Column, unit: Column, table: dict) -> Column:
    choice = None
    for name, weights in table.items():
        if name != "default":
            hit = weighted_pick(unit, weights)
            choice = F.when(region == name, hit) if choice is None else choice.when(region == name, hit)
    return choice.otherwise(weighted_pick(unit, table["default"]))


def region_of(country: Column) -> Column:
    choice = None
    for name, countries in cat.REGION_COUNTRIES.items():
        choice = F.when(country.isin(countries), name) if choice is None else choice.when(country.isin(countries), name)
    return choice.otherwise("default")


# ---------------------------------------------------------------- identifiers
def feature_id_parts(text: Column) -> dict[str, Column]:
    """`w123r#2` as OSM type, number, remainder flag and piece; NULLs when the text is no feature id."""
    pattern = r"^([nwr])([0-9]+)(r?)(#([0-9]+))?$"
    ok = text.rlike(pattern)
    part = lambda n: F.regexp_extract(text, pattern, n)
    kind = lookup({"n": "node", "w": "way", "r": "relation"}, part(1))
    return {"osm_type": F.when(ok, kind), "osm_id": F.when(ok, part(2).try_cast("bigint")),
            "remainder": F.when(ok, part(3) == "r"), "piece": F.when(ok, part(5).try_cast("bigint"))}


def chunk_name(i: Column, j: Column) -> Column:
    return F.concat(F.lit("c"), i.cast("string"), F.lit("_"), j.cast("string"))


def chunk_parts(text: Column) -> tuple[Column, Column]:
    pattern = r"^c(-?[0-9]+)_(-?[0-9]+)$"
    return tuple(F.regexp_extract(text, pattern, n).try_cast("int") for n in (1, 2))


@F.pandas_udf(StringType())
def fold_ascii(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without what is not ASCII (Spark has no normaliser)."""
    # Text by text: a batch of long ones isn't held four times.
    return text.map(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii"), na_action="ignore")


def slug(folded: Column, default: str = "city") -> Column:
    return first_of(F.regexp_replace(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(default))


def room_code(folded: Column, default: str, size: int = 11) -> Column:
    return first_of(F.substring(F.regexp_replace(F.upper(folded), "[^A-Z0-9-]", ""), 1, size), F.lit(default))


def map_code_full(text: Column) -> Column:
    """32-bit FNV-1a hash over code points, in base 36. The product stays in 64 bits: 16777619 = 2^24 + 403."""
    def step(h, letter):
        x = h.bitwiseXOR(code_point(letter))
        return F.pmod(x * 403 + F.pmod(x, F.lit(256)) * 16777216, F.lit(4294967296))
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.conv(F.aggregate(letters, F.lit(2166136261).cast("bigint"), step).cast("string"), 10, 36)


def map_code(text: Column) -> Column:
    """Last four digits of the base-36 hash."""
    return F.right(F.lpad(map_code_full(text), 8, "0"), F.lit(4))


def code_point(letter: Column) -> Column:
    """Unicode code point of a one-character string, from its big-endian UTF-32 bytes."""
    return F.conv(F.hex(F.encode(letter, "UTF-32")), 16, 10).cast("bigint")


# ---------------------------------------------------------------- positions
def format_dms(value: Column, positive: str, negative: str) -> Column:
    d = F.abs(value)
    minutes = F.rint((d - F.floor(d)) * 60).cast("bigint")
    return F.concat(F.floor(d).cast("string"), F.lit("°"), F.lpad(minutes.cast("string"), 2, "0"), F.lit("′ "),
                    F.when(value >= 0, positive).otherwise(negative))


def plane_scale(lat0: Column, model: Column) -> tuple[Column, Column]:
    """Metres per degree east and north at lat0: a sphere, or the ellipsoid's radii of curvature."""
    phi = F.radians(lat0)
    e2 = cat.WGS84_F * (2 - cat.WGS84_F)
    w = 1 - F.sin(phi) * F.sin(phi) * e2
    deg = math.pi / 180
    kx = F.when(model == "wgs84", F.cos(phi) / F.sqrt(w) * (cat.WGS84_A * deg)).otherwise(F.cos(phi) * cat.EARTH_M_PER_DEG)
    ky = F.when(model == "wgs84", F.lit(cat.WGS84_A * (1 - e2) * deg) / F.pow(w, F.lit(1.5))).otherwise(F.lit(cat.EARTH_M_PER_DEG))
    return kx, ky


def transverse_mercator(lat: Column, lon: Column, lon0: float = 15.0, scale: float = 0.9996,
                        false_east: float = 500000.0) -> tuple[Column, Column]:
    """Northing and easting by the Gauss-Krueger series on GRS 80."""
    f = cat.GRS80_F
    e2, n = f * (2 - f), f / (2 - f)
    k = scale * cat.WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    conformal = [e2, (5 * e2 ** 2 - e2 ** 3) / 6, (104 * e2 ** 3 - 45 * e2 ** 4) / 120, 1237 * e2 ** 4 / 1260]
    series = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
              61 * n ** 3 / 240 - 103 * n ** 4 / 140, 49561 * n ** 4 / 161280]
    phi, s = F.radians(lat), F.sin(F.radians(lat))
    poly = reduce(lambda acc, c: acc * s * s + c, reversed(conformal[:-1]), F.lit(conformal[-1]))
    conf = phi - s * F.cos(phi) * poly
    dl = F.radians(lon) - math.radians(lon0)
    xi, eta = F.atan(F.tan(conf) / F.cos(dl)), F.atanh(F.cos(conf) * F.sin(dl))
    north, east = xi, eta
    for order, b in enumerate(series, 1):
        north = north + F.sin(xi * (2 * order)) * F.cosh(eta * (2 * order)) * b
        east = east + F.cos(xi * (2 * order)) * F.sinh(eta * (2 * order)) * b
    return north * k, east * k + false_east


def bearing(dx: Column, dy: Column) -> Column:
    """Compass degrees, clockwise from north, of a vector east/north."""
    return F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))


def angle_between(a: Column, b: Column) -> Column:
    """a - b in degrees, wrapped to [-180, 180)."""
    return F.pmod(a - b + 180, F.lit(360.0)) - 180
