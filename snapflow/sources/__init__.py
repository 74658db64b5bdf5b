"""Sources: delimited text, file discovery, archives, workbooks, relational scans."""
