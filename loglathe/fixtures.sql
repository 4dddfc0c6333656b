WITH b AS (
  SELECT event_id, user_id, event_type, value,
    event_id % 12 AS m, event_id % 60 AS m60,
    CASE user_id % 6 WHEN 0 THEN '203.0.113.' WHEN 1 THEN '198.51.100.' WHEN 2 THEN '192.0.2.'
                     WHEN 3 THEN '10.20.30.' WHEN 4 THEN '192.168.5.' ELSE '172.21.9.' END || (user_id % 250 + 1) AS sip,
    '10.1.' || (user_id % 4) || '.' || (event_id % 250 + 1) AS dip,
    1024 + event_id % 60000 AS sport,
    CASE event_id % 5 WHEN 0 THEN 443 WHEN 1 THEN 53 WHEN 2 THEN 22 WHEN 3 THEN 3389 ELSE 8080 END AS dport,
    CASE event_id % 7 WHEN 0 THEN 'udp' WHEN 1 THEN 'gre' ELSE 'tcp' END AS proto,
    CASE event_type WHEN 'purchase' THEN 'blocked' WHEN 'signup' THEN 'alert' WHEN 'error' THEN 'drop' ELSE 'allowed' END AS act,
    substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8) AS iso,
    substr('JanFebMarAprMayJunJulAugSepOctNovDec', (month(ts) - 1) * 3 + 1, 3) || ' ' || day(ts) || ' ' || substr(CAST(ts AS STRING), 12, 8) AS bsd,
    1704067200000 + event_id * 61000 AS ms
  FROM events)
SELECT event_id AS seq,
  CASE WHEN m <= 2 OR m = 11 THEN 'syslog.log' WHEN m <= 5 THEN 'json.log' WHEN m <= 7 THEN 'cef.log' WHEN m <= 9 THEN 'unknown.log' ELSE 'mixed.log' END AS source_name,
  CASE
    WHEN m = 0 THEN bsd || ' FW01 %ASA-' || (event_id % 9) || '-106023: Deny ' || proto || ' src outside:' || sip || '/' || sport || ' dst inside:' || dip || '/' || dport || ' by access-group "OUTSIDE_IN"'
    WHEN m = 1 THEN bsd || ' FW02 %ASA-6-302013: Built outbound ' || upper(proto) || ' connection for outside:' || sip || '/' || dport || ' to inside:' || dip || '/' || sport
    WHEN m = 2 THEN bsd || ' VPN01 %ASA-6-113039: Group <VPN-USERS> User <u' || user_id || '> IP <' || sip || '> ' || CASE WHEN act = 'allowed' THEN 'AnyConnect session established' ELSE 'Session disconnected' END
    WHEN m = 3 THEN '{"ts": "' || iso || 'Z", "device": "relay-7", "src_ip": "' || sip || '", "dst_ip": "' || dip || '", "src_port": ' || sport || ', "dst_port": "' || dport || '", "protocol": "' || proto || '", "action": "' || act || '", "severity": "high"}'
    WHEN m = 4 THEN '{"timestamp": "' || iso || '+05:30", "vendor": "Harbor Sensor", "SOURCE_IP": "' || sip || '", "destination_ip": null, "server_ip": "' || dip || '", "sport": "n/a", "proto": "' || upper(proto) || '", "verdict": "' || upper(act) || '", "priority": "moderate"}'
    WHEN m = 5 THEN '{"event_time": ' || ms || ', "product": "gatepost", "srcip": "' || sip || '", "dstip": "' || dip || '", "sport": ' || sport || ', "dport": true, "action": "permit", "sev": 3}'
    WHEN m = 6 THEN 'CEF:0|Juniper|SRX|21.4|RT-FLOW|Session|' || (event_id % 12 + user_id % 13 - 6) || '|rt=' || ms || ' src=' || sip || ' dst=' || dip || ' spt=' || sport || ' dpt=' || dport || ' proto=' || proto || ' act=' || act || ' cat=Traffic'
    WHEN m = 7 THEN 'CEF:0| |PAN-OS|10.1|T-2|Allow|Very-High|msg=Access granted due to policy act=Accept start=' || iso || ' sourceAddress=' || sip || ' dst= spt=x'
    WHEN m = 8 THEN 'ALRT|' || iso || '|SEV' || (event_id % 4) || '|SRC=' || sip || ':' || sport || '|ACT=' || upper(act) || '|RULE=RL-' || (user_id % 9)
    WHEN m = 9 THEN 'connection from ' || sip || ' ' || dport || ' to ' || dip || ' was ' || act
    WHEN m60 = 10 THEN '<34>1 ' || iso || '.003Z FW02 firewall - ID47 - Deny tcp src ' || sip
    WHEN m60 = 22 THEN bsd || ' FW01 %ASA-6-999999: Some completely unrecognized message'
    WHEN m60 = 34 THEN '{open brace, no members ' || user_id || '}'
    WHEN m60 = 46 THEN 'CEF:0|Kestrel|cut short'
    WHEN m60 = 58 THEN '{"action": "blocked"}'
    WHEN m60 = 11 THEN '   '
    ELSE '  ' || bsd || ' FW03 Deny icmp src outside:' || sip || '/0 dst inside:' || dip || '/0  '
  END AS raw_text
FROM b
