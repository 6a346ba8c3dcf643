"""Column functions for tokens and vectors: word hashing, dense vectors, norms, similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of ASCII letters in the lower-cased text. Spark (Java regex) and the
# DuckDB oracle (RE2) agree on it.
TOKEN_PATTERN = "[a-z]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(text: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """All tokens of the lower-cased text, in order (array<string>); null stays null."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(pattern), 0)


def md5_hex_int(word: Column, start: int, length: int) -> Column:
    """Hex digits ``start``..``start+length-1`` (1-based) of ``md5(word)`` as a bigint."""
    return F.conv(F.substring(F.md5(word), start, length), 16, 10).cast("bigint")


def sql_name(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _md5_hex_int_sql(word: str, start: int, length: int) -> str:
    return f"CAST(conv(substring(md5({word}), {start}, {length}), 16, 10) AS BIGINT)"


# The vector builders below are written as SQL text and parsed once (F.expr): the same
# expression trees as the Column builders, without hundreds of Python-to-JVM calls per plan.

def hashed_pairs_sql(text: str, dim: int) -> str:
    """SQL for the (bucket, weight) pairs of ``text`` (an SQL expression): buckets ascending,
    equal buckets summed, zero weights dropped. Bucket = first 8 hex digits of md5(token) mod
    dim; sign = + when the 9th hex digit is even."""
    toks = f"regexp_extract_all(lower({text}), '{TOKEN_PATTERN}', 0)"
    signed = (f"array_sort(transform({toks}, w -> named_struct("
              f"'b', CAST({_md5_hex_int_sql('w', 1, 8)} % {dim} AS INT), "
              f"'w', IF({_md5_hex_int_sql('w', 9, 1)} % 2 = 0, 1, -1))))")
    empty = "CAST(array() AS array<struct<b:int,w:int>>)"
    merged = (f"aggregate(coalesce({signed}, {empty}), {empty}, (acc, p) -> "
              "IF(size(acc) > 0 AND element_at(acc, -1).b = p.b, "
              "concat(slice(acc, 1, size(acc) - 1), array(named_struct('b', p.b, 'w', element_at(acc, -1).w + p.w))), "
              "concat(acc, array(p))))")
    return f"filter({merged}, p -> p.w != 0)"


def densify_sql(pairs: str, dim: int) -> str:
    """SQL for the dense array<float> of ``dim`` entries from ascending (bucket, weight) pairs:
    runs of zeros and weights concatenated (native array copies, one lambda call per pair)."""
    return (f"aggregate({pairs}, named_struct('v', CAST(array() AS array<int>), 'last', -1), "
            "(acc, p) -> named_struct('v', concat(acc.v, array_repeat(0, p.b - acc.last - 1), array(p.w)), "
            "'last', p.b), "
            f"acc -> CAST(concat(acc.v, array_repeat(0, {dim - 1} - acc.last)) AS array<float>))")


def pairs_norm_sql(pairs: str) -> str:
    return (f"sqrt(aggregate({pairs}, CAST(0 AS DOUBLE), "
            "(s, p) -> s + CAST(p.w AS DOUBLE) * CAST(p.w AS DOUBLE)))")


def sparse_sql(pairs: str) -> str:
    """SQL for a sparse vector ``struct<indices: array<int>, values: array<float>>`` from pairs."""
    return (f"named_struct('indices', transform({pairs}, p -> p.b), "
            f"'values', transform({pairs}, p -> CAST(p.w AS FLOAT)))")


def sparse_vector(pairs: str) -> Column:
    """Sparse vector (indices ascending, no zeros) from the pairs in column ``pairs``."""
    return F.expr(sparse_sql(sql_name(pairs)))


def sparse_norm(vec: str) -> Column:
    """Euclidean norm (double) of a sparse vector column."""
    return F.expr(f"sqrt(aggregate({sql_name(vec)}.`values`, CAST(0 AS DOUBLE), "
                  "(s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))")


def hashed_pairs(text: str, dim: int) -> Column:
    """(bucket, weight) pairs of the hashed tokens of column ``text`` (array<struct<b,w>>)."""
    return F.expr(hashed_pairs_sql(sql_name(text), dim))


def densify(pairs: str, dim: int) -> Column:
    """Dense array<float> of ``dim`` entries from the pairs in column ``pairs``."""
    return F.expr(densify_sql(sql_name(pairs), dim))


def pairs_norm(pairs: str) -> Column:
    """Euclidean norm (double) of a vector given as the pairs in column ``pairs``."""
    return F.expr(pairs_norm_sql(sql_name(pairs)))


def hashed_vector(text: str, dim: int) -> Column:
    """Signed feature hashing of column ``text`` into ``dim`` buckets (array<float>).

    Entries are integer counts (exact in float), so similarity is exact on any engine; the
    norm is kept apart (:func:`pairs_norm`, :func:`norm`).
    """
    return F.expr(densify_sql(hashed_pairs_sql(sql_name(text), dim), dim))


def norm(vec: Column | str) -> Column:
    """Euclidean norm of an array of numbers, in double."""
    return F.sqrt(F.aggregate(_c(vec), F.lit(0.0).cast("double"),
                              lambda s, x: s + x.cast("double") * x.cast("double")))


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two arrays, in double (F16 building block)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def round_half_away(x: Column, digits: int = 6) -> Column:
    """``round(x * 10^d) / 10^d`` with halves away from zero, in double arithmetic.

    The same operations as the scoring kernel, so scores computed by an expression and by
    the kernel agree to the last bit.
    """
    scale = float(10 ** digits)
    y = x * F.lit(scale)
    return (F.signum(y) * F.floor(F.abs(y) + F.lit(0.5))) / F.lit(scale)


def cosine(a: Column | str, b: Column | str, digits: int = 6) -> Column:
    """Cosine similarity ``a.b / (|a| |b|)`` rounded to ``digits`` (F16)."""
    return round_half_away(dot(a, b) / (norm(a) * norm(b)), digits)


def dense_entries(vec: Column | str) -> Column:
    """(pos, value) entries of a dense vector, to be exploded (posexplode)."""
    return F.posexplode(_c(vec))


def has_dim(vec: Column | str, dim: int) -> Column:
    """True when the vector is present, has ``dim`` entries and no null entry."""
    v = _c(vec)
    return v.isNotNull() & (F.size(v) == dim) & (F.size(F.array_compact(v)) == dim)


def finite_norm(n: Column) -> Column:
    """True for a norm that is neither NaN nor infinite: a vector with a NaN or infinite entry
    has such a norm (in Spark, NaN is larger than any number)."""
    return n < F.lit(float("inf"))
