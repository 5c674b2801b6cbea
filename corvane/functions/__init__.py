"""Column functions: text, arrays and scalar formulas."""
