"""Plans: registered queries, oracle SQL, end-to-end workflows, plan checks."""
