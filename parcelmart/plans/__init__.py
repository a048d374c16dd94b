"""What the warehouse computes: dimensions, facts, the incremental load, reports and the risk model."""
