"""Jobs: compositions of the operators that apply policies, raise, and write audits."""
