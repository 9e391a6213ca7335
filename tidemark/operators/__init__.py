"""DataFrame in, DataFrame out: lazy, no paths, no actions."""
