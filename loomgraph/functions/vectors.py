"""Column functions on vectors and hashed features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column | str) -> Column:
    """Divided by its norm; a zero vector stays."""
    # An array of one binds vector and norm, else the norm would be taken anew for each component.
    bound = F.array(F.struct(_col(v).alias("v"), norm(v).alias("n")))
    return F.get(F.transform(bound, lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x / s["n"])).otherwise(s["v"])), F.lit(0))


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product; the cosine of normalised vectors.  Vectors of different lengths are an error."""
    a, b = _col(a), _col(b)
    value = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), value).otherwise(F.raise_error(F.lit("vectors of different dimensions")).cast("double"))


def round_vector(v: Column | str, digits: int = 6) -> Column:
    """Halves to even."""
    return F.transform(_col(v), lambda x: F.bround(x, digits))


def tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit("[a-z0-9]+"), F.lit(0))


def grams(toks: Column) -> Column:
    """Tokens, and neighbours joined by an underscore."""
    pairs = F.zip_with(F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0))), F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit("_"), b))
    return F.concat(toks, pairs)


def bucket_of(hash: Column | str, dim: int) -> Column:
    """The first four bytes of the MD5 (in hexadecimal digits), modulo the dimension."""
    return (F.conv(F.substring(_col(hash), 1, 8), 16, 10).cast("long") % dim).cast("int")


def sign_of(hash: Column | str) -> Column:
    """+1 or -1 by the low bit of the fifth byte."""
    odd = F.instr(F.lit("13579bdf"), F.substring(_col(hash), 10, 1)) > 0
    return F.when(odd, F.lit(1.0)).otherwise(F.lit(-1.0))


def bucket(gram: Column | str, dim: int) -> Column:
    return bucket_of(F.md5(_col(gram)), dim)


def sign(gram: Column | str) -> Column:
    return sign_of(F.md5(_col(gram)))


def weight(count: Column | str) -> Column:
    return 1.0 + F.ln(_col(count))
