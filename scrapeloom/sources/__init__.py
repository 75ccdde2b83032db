"""Daily CSV files in, written tables out."""
