"""Array expressions over probability vectors (Column -> Column, all JVM-side)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PROB_EPS = 1e-7


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once so a lambda over K elements does not recompute it K times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def vsum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def argmax(p: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def confidence(p: Column) -> Column:
    return F.array_max(p)


def margin(p: Column) -> Column:
    """Largest minus second largest probability."""
    return let(F.sort_array(p, asc=False), lambda s: F.get(s, F.lit(0)) - F.get(s, F.lit(1)))


def entropy(p: Column, eps: float = PROB_EPS, normalized: bool = True) -> Column:
    raw = -F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x * F.ln(x + F.lit(eps)))
    return raw / F.ln(F.size(p).cast("double")) if normalized else raw


def kl(p: Column, q: Column, eps: float = PROB_EPS) -> Column:
    return vsum(F.zip_with(p, q, lambda x, y: x * F.ln((x + F.lit(eps)) / (y + F.lit(eps)))))


def softmax(z: Column) -> Column:
    shifted = let(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(x - m)))
    return let(shifted, lambda e: let(vsum(e), lambda s: F.transform(e, lambda x: x / s)))


def log_clipped(p: Column, eps: float = PROB_EPS) -> Column:
    return F.transform(p, lambda x: F.ln(F.least(F.greatest(x, F.lit(eps)), F.lit(1.0))))


def apply_temperature(p: Column, temperature: float) -> Column:
    """softmax(ln p / T); T = 1 leaves the vector untouched."""
    if temperature == 1.0:
        return p
    return softmax(F.transform(log_clipped(p), lambda x: x / F.lit(float(temperature))))


def derived_features(p_text: Column, p_image: Column) -> list[Column]:
    """Agreement, margins, maxima, normalized entropies and KL(text || image)."""
    return [
        (argmax(p_text) == argmax(p_image)).cast("double").alias("agreement"),
        margin(p_text).alias("margin_text"),
        margin(p_image).alias("margin_image"),
        confidence(p_text).alias("max_text"),
        confidence(p_image).alias("max_image"),
        entropy(p_text).alias("entropy_text"),
        entropy(p_image).alias("entropy_image"),
        kl(p_text, p_image).alias("kl_text_img"),
    ]


def meta_vector(p_text: Column, p_image: Column, tabular: Column, derived: Column | None = None) -> Column:
    parts = [p_text, p_image, tabular]
    if derived is not None:
        parts.append(derived)
    return F.concat(*parts)


def one_hot(pred: Column, n_classes: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda c: (c == pred).cast("double")
    )


def align_classes(p: Column, classes: Sequence[int], n_classes: int) -> Column:
    """Scatter a model's own class columns into ``n_classes`` slots, 0 elsewhere."""
    position = {int(c): i for i, c in enumerate(classes)}
    return F.array(
        *[
            F.get(p, F.lit(position[c])) if c in position else F.lit(0.0)
            for c in range(n_classes)
        ]
    )


def pack_columns(columns: Sequence[str], element: str = "double") -> Column:
    return F.array(*[F.col(c).cast(element) for c in columns])


def unpack_columns(vector: Column, names: Sequence[str]) -> list[Column]:
    return [F.get(vector, F.lit(i)).alias(n) for i, n in enumerate(names)]


def has_nan(v: Column) -> Column:
    return F.exists(v, lambda x: F.isnan(x) | x.isNull())


def p_of(p: Column, label: Column) -> Column:
    return F.get(p, label)


def nll(p: Column, label: Column, eps: float = math.ulp(1.0)) -> Column:
    """-ln p[label], clipped to [eps, 1 - eps] as in double precision."""
    chosen = F.coalesce(p_of(p, label), F.lit(0.0))
    return -F.ln(F.least(F.greatest(chosen, F.lit(eps)), F.lit(1.0 - eps)))


def brier(p: Column, label: Column) -> Column:
    """Sum over classes of (p - onehot)^2, written as sum p^2 - 2 p[y] + 1."""
    squares = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x * x)
    return squares - 2.0 * F.coalesce(p_of(p, label), F.lit(0.0)) + 1.0
