"""Named queries, the fused suite, the pipelines, and the driver registry with its oracle SQL."""
