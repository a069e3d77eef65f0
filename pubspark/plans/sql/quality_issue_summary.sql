-- Per issue type: distinct affected DOIs (NULL DOIs are not counted) and affected rows.
-- Parameter: {quality_issues} = silver quality issues.
SELECT issue_type,
       count(DISTINCT doi) AS affected_publications,
       sum(affected_row_count) AS affected_rows
FROM {quality_issues}
GROUP BY issue_type
ORDER BY affected_publications DESC, issue_type ASC
