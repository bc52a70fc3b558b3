"""Sources and sinks: bar/seed readers, ingest steps, table writers, test-data adapters."""

from sessionmart.sources.readers import conform, read_bars, read_results, read_seed, read_setups

__all__ = ["conform", "read_bars", "read_results", "read_seed", "read_setups"]
