from censusloom.sinks.export import export_levels, level_rows, preview, write_level, write_levels
from censusloom.sinks.metrics import LevelMetrics, observed_level_stats, observed_nulls, observed_validation
from censusloom.sinks.publishing import publish, recover

__all__ = [n for n in dir() if not n.startswith("_")]
