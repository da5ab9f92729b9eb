"""Column functions: escaping, names, numbers, times, arrays, decimals."""
