"""Training-data operators: ten text and vector jobs and the queries that apply them."""
