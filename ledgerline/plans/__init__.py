"""Plans: compositions of operators into the ledger, the publication run and registered queries."""
