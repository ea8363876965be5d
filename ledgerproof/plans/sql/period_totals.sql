-- Rows and amounts per provider in a period, bound by :start and :end. A day that is none is in no period.
SELECT lower(trim(payment_provider_name))                        AS provider,
       count(*)                                                  AS cnt,
       CAST(sum(try_cast(total_cashout_usd AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_total_cashout_usd
FROM {payout}
WHERE withdrawal_created_at >= :start AND withdrawal_created_at < :end
  AND left(withdrawal_created_at, 10) RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'
  AND try_cast(left(withdrawal_created_at, 10) AS DATE) IS NOT NULL
GROUP BY lower(trim(payment_provider_name))
