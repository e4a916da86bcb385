"""Training-data operators and the queries over them."""
