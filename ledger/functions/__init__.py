"""Column expressions: price precedence, classification, money, display time, month bounds."""
