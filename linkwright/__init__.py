"""Entity resolution as DataFrame operators: normalise, block, compare, score, evaluate and validate."""
