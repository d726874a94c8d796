"""Loan-portfolio risk analytics as Spark DataFrame, SQL and MLlib jobs."""
