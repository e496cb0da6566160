"""Reading the CSV inputs, and reading and writing stages and reports."""
