"""Exploratory statistics: counts, histograms, grouped summaries, lines,
correlations, regression and density grids. Each returns a small tidy
DataFrame (one row per bin, group, cell or coefficient)."""
