"""Spark-native toolkit for reconciling large payout and bank ledgers."""
