"""Writers: idempotent tables, CSV, time-series points, streams."""
