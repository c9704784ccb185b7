"""Feature plans: one module per source table, and the matrix that joins them."""
