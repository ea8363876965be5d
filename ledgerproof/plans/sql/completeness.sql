-- Rows of both ledgers in the period; a cell such as ';' divides no statement.
SELECT 'payout; period' AS label, count(*) AS cnt
FROM {payout}
WHERE left(withdrawal_created_at, 10) >= :start AND left(withdrawal_created_at, 10) < :end;

SELECT 'bank' AS label, count(*) AS cnt
FROM {bank}
WHERE left(created_at, 10) >= :start AND left(created_at, 10) < :end;

/* Ids that occur more than once; without a period. */
SELECT 'doubled ' || payment_method AS label, count(*) AS cnt
FROM (SELECT tms_reconciliation_id, payment_method FROM {payout}
      WHERE tms_reconciliation_id IS NOT NULL
      GROUP BY tms_reconciliation_id, payment_method HAVING count(*) > 1)
GROUP BY payment_method;
