"""DataFrame operators: popularity, farthest-first coresets, weighted
k-center with outliers, objective."""
