"""Table operators: cleaning steps, issue detection, joins and checks."""
