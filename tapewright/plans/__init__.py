"""Query compositions: the serving queries, monitoring, and the queries over the driver tables."""
