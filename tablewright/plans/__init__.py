"""Table definitions and versioned table sets."""
