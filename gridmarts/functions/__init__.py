"""Column-level helpers: time parsing, lenient casts, means and labels."""
