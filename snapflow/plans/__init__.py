"""Jobs composed from the operators: member extract, super users, incidents (G1-G3), and the
operator queries over the driver's tables."""
