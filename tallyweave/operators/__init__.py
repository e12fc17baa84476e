"""DataFrame-to-DataFrame operators, named after the data step they do."""
