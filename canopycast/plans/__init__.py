"""Chains of operators: dataset build, diagnostics and training."""
