"""DataFrame-to-DataFrame operators: lazy, parameterised, no driver-side data."""
