"""Rows as time-series points in line protocol: ``name,tag=v field=v time``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tag(value: Column) -> Column:
    return F.regexp_replace(value, r"([,= ])", r"\\$1")


def line(
    measurement: str, tags: dict[str, Column], fields: dict[str, Column], millis: Column | None = None
) -> Column:
    """A null tag or field is left out, as is the time when none is given."""
    head = F.concat_ws(",", F.lit(measurement), *[F.concat(F.lit(f"{k}="), _tag(v)) for k, v in tags.items()])
    body = F.concat_ws(
        ",", *[F.concat(F.lit(f"{k}="), v.cast("double").cast("string")) for k, v in fields.items()]
    )
    end = [millis.cast("string")] if millis is not None else []
    return F.concat_ws(" ", head, body, *end)


def trade_points(trades: DataFrame) -> DataFrame:
    return trades.select(
        line(
            "stock_prices",
            {"symbol": F.col("symbol")},
            {"price": F.col("price"), "volume": F.col("volume")},
            F.unix_millis("ts"),
        ).alias("value")
    )


def prediction_points(predictions: DataFrame) -> DataFrame:
    """Predictions carry their day as a tag and no time."""
    return predictions.select(
        line(
            "stock_predictions",
            {"symbol": F.col("symbol"), "date": F.date_format("target_date", "yyyy-MM-dd")},
            {c: F.col(c) for c in ("high", "low", "close", "volume")},
        ).alias("value")
    )


def write_points(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    points.write.mode(mode).text(path)
