"""Scrapeloom: Spark jobs that turn daily files of scraped company listings
into clean tables, resolved companies, a star schema and reports."""
