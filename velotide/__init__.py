"""velotide: station-hour demand, supply gaps and dynamic prices as Spark jobs."""

__version__ = "0.1.0"
