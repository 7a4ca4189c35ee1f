"""Views, dashboard reports and query-log reports."""
