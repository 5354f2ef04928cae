"""Multi-step computations composed of operators."""
