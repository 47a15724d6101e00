"""Column expressions: text, dates, numbers, encodings. All are safe under ANSI mode."""
