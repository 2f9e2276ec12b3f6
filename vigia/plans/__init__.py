"""Plans: the warehouse ETL, the analytical views and dashboard aggregates."""
