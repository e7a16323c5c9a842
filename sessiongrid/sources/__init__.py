"""Tables in files: snapshots, reference CSVs, HTML pages and reports."""
