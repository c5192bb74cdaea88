"""Clause extraction, retrieval and scoring over large document tables, as Spark jobs."""
