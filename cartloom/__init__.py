"""cartloom: retail stock, price, order and party dataflows as Spark DataFrame functions."""
