"""Corpus curation on Spark: DataFrame operators for discovering, scoring, cleaning and deduplicating documents."""
