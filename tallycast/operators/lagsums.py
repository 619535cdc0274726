"""Lag products of whole series as mergeable summaries, and the fits that need nothing else.

A summary is a row of SUMMARY columns (see ``functions.stretches``). Spark sums the products; per key, or per key and block, one row is left.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.functions import likelihood, solvers, stretches
from tallycast.operators import autoregression as ar

SUMMARY = (
    "n bigint, products array<double>, head array<double>, tail array<double>, "
    "first_minute bigint, first_total double, last_minute bigint, last_total double"
)
SUMMARY_NAMES = [part.split()[0] for part in SUMMARY.split(", ")]


def product_terms(lags: int) -> dict[str, Column]:
    """What a row of lag features adds: 1 to ``n`` and its difference's products with itself and those before it.

    Lags that the series doesn't have yet add nothing. Sums run in double: exact for integers below 2**53.
    """
    d = F.col("d").cast("double")
    past = [d, *(F.col(f"l{i}").cast("double") for i in range(1, lags + 1))]
    products = {f"p_{h}": F.coalesce(d * x, F.lit(0.0)) for h, x in enumerate(past)}
    return {"n": F.col("d").isNotNull().cast("bigint")} | products


def chronological(lags: int) -> Column:
    """The newest differences of a row of lag features, oldest first."""
    return F.array_compact(F.reverse(ar.recent(lags)))


def lag_summary(
    series: DataFrame, by: Sequence[str] = ("key",), ts: str = "ts", value: str = "total", lags: int = ar.LAGS
) -> DataFrame:
    """One summary per series, and its last time: ``(*by, SUMMARY, last_ts)``. The rows are the series' steps, numbered from 0."""
    in_order = W.partitionBy(*by).orderBy(ts)
    features = ar.lag_features(series, by, ts, value, lags).withColumn("_at", F.row_number().over(in_order).cast("bigint") - 1)
    starts = F.when(F.col("_at").between(1, lags), F.struct("_at", F.col("d").cast("double").alias("d")))
    last = F.struct(F.col("_at"), F.col(value).cast("double").alias("total"), F.col(ts).alias("ts"), chronological(lags).alias("tail"))
    total = F.col(value).cast("double")
    return (
        features.groupBy(*by)
        .agg(
            *[F.sum(term).alias(name) for name, term in product_terms(lags).items()],
            F.sort_array(F.collect_list(starts)).alias("_starts"),
            F.min_by(total, F.col("_at")).alias("first_total"),
            F.max_by(last, F.col("_at")).alias("_last"),
        )
        .select(
            *by,
            "n",
            F.array(*(f"p_{h}" for h in range(lags + 1))).alias("products"),
            F.transform("_starts", lambda x: x["d"]).alias("head"),
            F.col("_last.tail").alias("tail"),
            F.lit(0).cast("bigint").alias("first_minute"),
            "first_total",
            F.col("_last._at").alias("last_minute"),
            F.col("_last.total").alias("last_total"),
            F.col("_last.ts").alias("last_ts"),
        )
    )


def stretch_of(row, lags: int) -> stretches.Stretch:
    """A row of SUMMARY columns (a mapping) as a stretch; missing values stay NaN."""
    vector = lambda x: np.array([np.nan if v is None else v for v in x], float)
    return stretches.Stretch(
        int(row["n"]), vector(row["products"])[: lags + 1], vector(row["head"])[:lags], vector(row["tail"])[-lags:],
        int(row["first_minute"]), float(row["first_total"]), int(row["last_minute"]), float(row["last_total"]),
    )


def stretches_of(columns: dict[str, pa.Array], lags: int) -> stretches.Stretches:
    """SUMMARY columns without missing values as stretches."""
    plain = {name: column.to_numpy(zero_copy_only=False) for name, column in columns.items() if not pa.types.is_list(column.type)}
    rows, place = len(plain["n"]), np.arange(lags)
    held = np.minimum(plain["n"], lags)[:, None]
    ends = {"head": place < held, "tail": place >= lags - held}
    for name, where in ends.items():
        plain[name] = np.zeros((rows, lags))
        plain[name][where] = columns[name].flatten().to_numpy()
    plain["products"] = columns["products"].flatten().to_numpy().reshape(rows, lags + 1)
    return stretches.Stretches(**{name: plain[name] for name in SUMMARY_NAMES})


def summary_arrays(found: stretches.Stretches) -> list[pa.Array]:
    """Stretches as SUMMARY columns."""
    lags = found.head.shape[1]
    held, place = np.minimum(found.n, lags), np.arange(lags)
    lists = {
        "products": (np.full(len(held), lags + 1), found.products.ravel()),
        "head": (held, found.head[place < held[:, None]]),
        "tail": (held, found.tail[place >= lags - held[:, None]]),
    }
    out = []
    for name in SUMMARY_NAMES:
        if name in lists:
            sizes, values = lists[name]
            out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.float64())))
        else:
            out.append(pa.array(getattr(found, name)))
    return out


def map_versions(gathered: DataFrame, fold: Callable[[dict[str, pa.Array]], stretches.Versions], by: Sequence[str]) -> DataFrame:
    """``(*by, interval, SUMMARY)``: each row's ``parts``, a list of structs, as the versions that ``fold`` makes of the structs' columns."""
    kinds = {f.name: f.dataType.simpleString() for f in gathered.schema.fields}
    fields = gathered.schema["parts"].dataType.elementType.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of_row, parts = [], [], batch.column("parts")
            for i in range(len(parts)):
                found.append(fold(dict(zip(fields, parts[i].values.flatten()))))
                of_row.append(np.full(len(found[-1][0]), i))
            if not found:
                continue
            same = pa.array(np.concatenate(of_row))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(same) for name in by),
                    pa.array(np.concatenate([at for at, _ in found])),
                    *summary_arrays(stretches.stacked([x for _, x in found])),
                ],
                names=[*by, "interval", *SUMMARY_NAMES],
            )

    keys = ", ".join(f"`{name}` {kinds[name]}" for name in by)
    return gathered.mapInArrow(run, f"{keys}, interval bigint, {SUMMARY}")


def fit_conditional(wholes: list[stretches.Stretch], lags: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, status and usable rows by conditional least squares, as ``autoregression.fit`` gives them."""
    gram, target, rows = np.zeros((len(wholes), lags, lags)), np.zeros((len(wholes), lags)), np.zeros(len(wholes), int)
    for i, whole in enumerate(wholes):
        gram[i], target[i], rows[i] = stretches.normal_equations(whole, lags)
    phi, status = solvers.solve_lags(gram, target, rows)
    return phi, status, rows


def exact_models(wholes: list[stretches.Stretch], lags: int) -> dict[str, np.ndarray]:
    """Maximum-likelihood coefficients, variance and log-likelihood, with a status for each stretch.

    ``ok``; ``insufficient`` with no more than twice as many differences as lags; ``failed`` where values are missing or infinite;
    ``still`` where the total never moves (coefficients 0, no likelihood); ``boundary`` where the likelihood grows up to the border of
    the stationary region, as for a constant slope: its coefficients are those at the border.
    """
    size = len(wholes)
    phi, variance, likely = np.full((size, lags), np.nan), np.full(size, np.nan), np.full(size, np.nan)
    n = np.array([x.n for x in wholes], int)
    finite = np.array([np.isfinite(x.products).all() and np.isfinite(x.head).all() and np.isfinite(x.tail).all() for x in wholes], bool)
    moves = np.array([x.products[0] > 0 for x in wholes], bool)
    enough = finite & (n > 2 * lags)
    status = np.select([~finite, ~enough, ~moves], ["failed", "insufficient", "still"], "boundary").astype(object)
    phi[enough & ~moves], variance[enough & ~moves] = 0.0, 0.0
    at = np.flatnonzero(enough & moves)
    if len(at):
        matrices = np.array([stretches.likelihood_matrix(wholes[i], lags) for i in at])
        phi[at], variance[at], likely[at], settled = likelihood.fit(matrices, n[at])
        status[at[settled]] = "ok"
    return {"phi": phi, "sigma2": variance, "log_likelihood": likely, "status": status, "n": n}


def fit_exact(
    series: DataFrame, by: Sequence[str] = ("key",), ts: str = "ts", value: str = "total", lags: int = ar.LAGS
) -> DataFrame:
    """One model per series by exact Gaussian maximum likelihood of its differences under a stationary autoregression.

    Columns as ``autoregression.fit`` (``n`` counts all differences), ``sigma2`` and ``log_likelihood``; so ``forecast`` takes them.
    """
    summaries = lag_summary(series, by, ts, value, lags)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wholes = [stretch_of(row, lags) for row in batch[SUMMARY_NAMES].to_dict("records")]
            found = exact_models(wholes, lags)
            out = batch[[*by, "n", "last_ts"]].copy()
            out["last_value"] = batch["last_total"]
            known = ~np.isnan(found["phi"]).any(1)
            # The recursion starts from the newest difference.
            out["tail"] = pd.Series([x.tail[::-1].tolist() for x in wholes], index=out.index, dtype=object)
            out["phi"] = pd.Series([x.tolist() if k else None for x, k in zip(found["phi"], known)], index=out.index, dtype=object)
            out["sigma2"] = pd.Series([x if k else None for x, k in zip(found["sigma2"], known)], index=out.index, dtype=object)
            likely = found["log_likelihood"]
            out["log_likelihood"] = pd.Series([None if np.isnan(x) else x for x in likely], index=out.index, dtype=object)
            out["status"] = found["status"]
            yield out

    kinds = {f.name: f.dataType.simpleString() for f in series.schema.fields}
    keys = ", ".join(f"`{c}` {kinds[c]}" for c in by)
    return summaries.mapInPandas(
        run,
        f"{keys}, n bigint, last_ts {kinds[ts]}, last_value double, tail array<double>, phi array<double>, "
        "sigma2 double, log_likelihood double, status string",
    )
