"""linestream: line-stream analytics (parse, geotag, forward, burst
statistics) as Spark DataFrame operators. See README.md."""

__version__ = "0.1.0"
