"""DataFrame operators: naming, quality, silver build, grants, masking, history."""
