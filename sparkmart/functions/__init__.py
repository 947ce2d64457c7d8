"""Column functions: time, business codes and JSON."""
