"""Training-data operators: numbered operators and the queries over them."""
