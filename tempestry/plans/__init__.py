"""Whole jobs: the one-pass rollup and the consolidated report."""
