"""faunagrid: biodiversity indicators on a hierarchical hexagonal grid, computed by Spark."""
