"""Column expressions: dates, amounts, business rules, random draws."""
