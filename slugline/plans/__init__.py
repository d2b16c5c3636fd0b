"""Parameters of the reports and the plans that combine operators."""
