"""Load patterns for warehouse dimensions: landing, quality gates, de-duplication and versioned history."""
